"""Secret scans by grammar inference.

Plain patterns find credentials whose kind is written beside them or plain from their letters. What they find teaches a
probabilistic automaton per kind, and so do made-up credentials of public formats; ordinary words of the documents, alone and
joined to identifiers and paths, teach one more. The automata run over classes of characters. Then every other string
is scored: its class sequence by the automata, its letters by how words follow one letter by another.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabmill.llm.automata import learn, log_chance
from tabmill.llm.common import arrow_type, per_text, slices, texts
from tabmill.session import cut

KINDS = ("assign", "access", "hex", "format")
ORDINARY = -1
EXAMPLES = 1000     # distinct strings of a kind that an automaton is learned from, the first by hash
MADE_UP = 200       # strings made up of each public format
EVIDENCE = 8.0      # log likelihood by which a credential's automaton must beat that of ordinary strings
LOWEST = 0.02       # share of a kind's own examples that may score below its limit
WORDS = 8           # words that a document puts up as ordinary
KNOWN = 200_000     # short candidates of which a worker remembers the verdict
SHORT = 40          # characters of these

# Public formats as parts of (prefix, alphabet, least and most characters).
BASE62 = string.ascii_letters + string.digits
URL64 = BASE62 + "-_"
FORMATS = (
    (("", BASE62, 20, 32),),
    (("", BASE62 + "+/", 40, 44),),
    (("", "0123456789abcdef", 32, 64),),
    (("ghp_", BASE62, 36, 36),),
    (("sk_live_", BASE62, 24, 32),),
    (("eyJ", URL64, 17, 40), (".eyJ", URL64, 30, 120), (".", URL64, 43, 43)),
)

# Fixed patterns of the base kinds: the keyword's letters in either case, group 2 is the value.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer fails either way
KEYWORDS = ("pass", "secret", "token", "api")
LEAST = 6           # characters of a candidate, or of what base spans leave of it, as of an assigned value
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % LEAST)
JOINTS = "+/_=.-"
EDGES = ".-"        # that end a sentence or a range, and no candidate
WORDLIKE = re.compile(r"[A-Za-z0-9]{4,40}")

CLASS = str.maketrans({**{c: "a" for c in "abcdef"}, **{c: "g" for c in "ghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEF"},
                       **{c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in string.digits}})

FOUND = "doc_id long, kinds array<int>, values array<string>, words array<string>"
OUT = "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the base kinds, by start, then kind."""
    out = []
    folded = text.lower()  # only to skip texts without any keyword; no letter outside ASCII lowers into one alone
    if any(k in folded for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def collect(doc_id: int | None, text: str | None) -> tuple:
    """A document's base spans, its candidates besides, and some of its words."""
    text = text or ""
    spans = sorted([*base_spans(text), *candidates(text, base_spans(text))])
    return (doc_id, [s[1] for s in spans], [s[0] for s in spans], [s[2] for s in spans], [s[3] for s in spans], some_words(text))


def candidates(text: str, base: list[tuple]) -> Iterator[tuple[int, int, int, str]]:
    """Every string that may be a credential, in the form of ``base_spans``, without what base spans cover of it."""
    at, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        parts, cursor = [], max(m.start(), reach)
        while at < len(base) and base[at][0] < m.end():
            parts.append((cursor, base[at][0]))
            reach = max(reach, base[at][2])
            cursor = max(cursor, reach)
            at += 1
        for a, b in [*parts, (cursor, m.end())]:  # what base spans leave of it, without what joins the two
            while a < b and text[a] in (JOINTS if a > m.start() else EDGES):
                a += 1
            while a < b and text[b - 1] in (JOINTS if b < m.end() else EDGES):
                b -= 1
            if b - a >= LEAST:
                yield a, 3, b, text[a:b]


def some_words(text: str) -> list[str]:
    """``WORDS`` of the words of a text, the first by hash: texts that share these words choose the same ones."""
    return sorted(set(WORDLIKE.findall(text)), key=lambda w: (zlib.crc32(w.encode()), w))[:WORDS]


def taught(doc_id: int | None, text: str | None) -> tuple:
    """What a document teaches: its base matches and some words."""
    base = base_spans(text or "")
    return doc_id, [s[1] for s in base], [s[3] for s in base], some_words(text or "")


def examples(found: DataFrame) -> dict[int, list[str]]:
    """Distinct strings by kind, at most ``EXAMPLES`` each, the first by hash; ``ORDINARY`` are words of two rows or more,
    as credentials seldom are."""
    out = {}
    values = found.select(F.explode(F.arrays_zip("kinds", "values")).alias("v")).select("v.kinds", "v.values")
    for kind in (0, 1, 2):
        out[kind] = values.where(F.col("kinds") == kind).select(F.col("values").alias("value"))
    out[ORDINARY] = found.select(F.explode("words").alias("value")).groupBy("value").count().where("count > 1").select("value")
    return {kind: sorted(r["value"] for r in rows.distinct().orderBy(F.xxhash64("value"), "value").limit(EXAMPLES).collect())
            for kind, rows in out.items()}


def made_up(seed: int = 5) -> dict[int, list[str]]:
    """Credentials of the public formats by kind, from 4 on; always the same."""
    random = Random(seed)
    return {4 + i: ["".join(prefix + "".join(random.choices(letters, k=random.randint(low, high)))
                            for prefix, letters, low, high in parts) for _ in range(MADE_UP)]
            for i, parts in enumerate(FORMATS)}


def joined(words: list[str], seed: int = 7) -> list[str]:
    """Identifiers, paths and names as people make them of words, and numbers and dates."""
    random = Random(seed)
    out = []
    for word in words:
        other, third = random.choice(words), random.choice(words)
        number = str(random.randrange(100))
        out.append(random.choice([
            word + other.capitalize(), word.capitalize() + other.capitalize() + third.capitalize(), f"{word}_{other}",
            f"{word}-{other}", f"{word}_{other}_{number}", f"{word}.{other}.{third}", f"{word}/{other}/{third}.{other[:3]}",
            f"/{word}/{other}{number}", word + number, word + other.capitalize() + number, f"{word}={number}", f"{word}.{number}",
            str(random.randrange(10 ** random.randint(6, 24))), f"{random.randrange(1900, 2100)}-{random.randint(10, 12)}-{number}"]))
    return out


def folded(value: str) -> str:
    """Strings of capitals only are read as small ones."""
    return value if any("a" <= c <= "z" for c in value) else value.lower()


def followers(words: list[str]) -> dict[str, float]:
    """For a pair of small letters, the log likelihood of the second within its class if all of the class were equally
    likely, less that after the first in words."""
    pairs = Counter(a + b for w in words for a, b in zip(w.lower(), w.lower()[1:]))
    out = {}
    for first in string.ascii_lowercase:
        for letters in ("abcdef", "ghijklmnopqrstuvwxyz"):
            n = sum(pairs[first + c] for c in letters) + 0.5 * len(letters)
            out.update({first + c: -math.log(len(letters)) - math.log((pairs[first + c] + 0.5) / n) for c in letters})
    return out


def unlike_words(follow: dict[str, float], value: str) -> float:
    """Log likelihood of the letters of a string, given their classes, as drawn evenly less that as letters of words."""
    low = value.lower()
    return sum(follow.get(low[i:i + 2], 0.0) for i in range(len(low) - 1))


def detector(samples: dict[int, list[str]]) -> dict[int, tuple]:
    """Automaton and least score of each kind that has examples; of ordinary strings the automaton and ``followers``."""
    out = {}
    for kind, strings in samples.items():
        if strings and kind != ORDINARY:
            shapes = [folded(s).translate(CLASS) for s in strings]
            model = learn(shapes)
            out[kind] = (model, float(np.quantile([log_chance(model, s) for s in shapes], LOWEST)))
    words = samples.get(ORDINARY)
    if words:
        out[ORDINARY] = (learn([folded(s).translate(CLASS) for s in [*words, *joined(words)]]), followers(words))
    return out


def likely(models: dict[int, tuple], value: str) -> bool:
    """Whether a string has the format of a credential rather than of ordinary text. Without words nothing has."""
    if ORDINARY not in models:
        return False
    ordinary, follow = models[ORDINARY]
    value = folded(value)
    shape = value.translate(CLASS)
    symbols = len(shape) + 1
    ahead = unlike_words(follow, value) - log_chance(ordinary, shape) * symbols
    if ahead < EVIDENCE:  # no automaton gives more than likelihood 1
        return False
    for kind, (model, least) in models.items():
        if kind >= 0:
            score = log_chance(model, shape)
            if score >= least and score * symbols + ahead >= EVIDENCE:
                return True
    return False


def scan(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every whole text: ``doc_id, n_assign, n_access, n_hex, n_format, base_sha256, spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind; base spans stay whatever the automata
    say, and ``format`` spans lie outside them. A null text counts as an empty one: no spans, empty lists. Repeated rows give
    equal rows, an empty table none; other columns are not read. Texts are read twice, to learn and to score; examples are
    a bounded choice by hash, everything else covers all rows. Every string of ``LEAST`` characters or more is scored.
    """
    found = cut(per_text(docs, taught, FOUND))
    # bounded by the examples
    models = docs.sparkSession.sparkContext.broadcast(detector({**examples(found), **made_up()}))
    schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in OUT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}

        def secret(value: str) -> bool:
            if len(value) > SHORT:
                return likely(models.value, value)
            verdict = known.get(value)
            if verdict is None:
                if len(known) >= KNOWN:
                    known.clear()
                verdict = known[value] = likely(models.value, value)
            return verdict

        for batch in batches:
            for some in slices(batch):
                rows = []
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    text = text or ""
                    base = base_spans(text)
                    extra = [s for s in candidates(text, base) if secret(s[3])]
                    counts = Counter(s[1] for s in [*base, *extra])
                    rows.append((key, *(counts[k] for k in range(4)), listed(base), listed(sorted([*base, *extra]))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return texts(docs).mapInArrow(run, OUT).withColumn("base_sha256", F.sha2("base_sha256", 256))


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)
