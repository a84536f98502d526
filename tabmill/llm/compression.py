"""Quality rules by compression bands.

How much a text shrinks under zstandard says how repetitive it is. Natural text of one length stays in a band: below it
lies what does not compress (keys, encoded data), above it what says the same again and again. A text is compressed as a whole
in chunks of fixed size and in longer runs that overlap, so that a short stretch of a long text is seen as well; one chunk or run
outside its band rejects the text. Random digits shrink about as much as prose in pieces under 8 KiB: there they pass.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from tabmill.llm.common import per_text

CHUNK = 4096        # bytes
RUN = 16384         # bytes; runs start every half of it
LEVEL = 3
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50    # base rule
REPEATED = 50       # base rule: per cent of the words in repeated windows

# Bytes from which a band holds, least and largest ratio of raw to compressed bytes of a whole text.
# From the labelled clean texts of sf0.1 and 30,000 rows of check_s that pass the base rules: 2 to 8 % below the least ratio of the
# length class, 25 % above the largest of sf0.1. No such text is as long as the last class: its largest ratio only leaves room.
WHOLE = ((0, 1.28, 2.31), (512, 1.36, 2.47), (1024, 1.60, 2.69), (2048, 1.77, 2.77), (4096, 1.91, 2.93), (8192, 2.11, 3.01),
         (16384, 2.20, 3.10), (131072, 2.20, 5.0))
CHUNKS = (1.91, 2.82)   # the same of all full chunks of these texts
RUNS = (2.19, 3.04)     # and of all full runs

OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, ratio double, bad_share double")


def band(size: int, limits: tuple) -> tuple[float, float]:
    """Least and largest ratio for ``size`` bytes."""
    return max(b for b in limits if b[0] <= size)[1:]


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found twice or more, the first one included."""
    n = len(words)
    if n < 3:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, spots, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[spots] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= again
    return int(hit.sum())


def ratios(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float]:
    """Ratio of the whole and the share of bytes in chunks and runs outside their band.

    The last chunk and run are full ones that end with the text; a shorter text has none but itself.
    """
    whole = len(raw) / len(packer.compress(raw))
    bad = np.zeros(len(raw), bool)
    for size, step, (low, high) in ((CHUNK, CHUNK, CHUNKS), (RUN, RUN // 2, RUNS)):
        last = len(raw) - size
        for at in sorted({min(at, last) for at in range(0, last + step, step)}) if last >= 0 else ():
            if not low <= size / len(packer.compress(raw[at:at + size])) <= high:
                bad[at:at + size] = True
    return whole, float(bad.sum()) / len(raw)


def measure(doc_id: int | None, text: str | None) -> tuple:
    """One document's row."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeats > REPEATED * n
    whole, bad = None, None
    kept = False
    if raw:
        whole, bad = ratios(raw, zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
        low, high = band(len(raw), WHOLE)
        kept = not failed and low <= whole <= high and not bad
    return (doc_id, n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats, failed, kept, whole, bad)


def rules(docs: DataFrame) -> DataFrame:
    """Base counts and the compression verdict of every whole text; see ``OUT`` for the columns.

    A null text counts as an empty one: no words, not kept, no ratio. Repeated rows are judged alike, ids are only handed
    through, an empty table gives no rows, and other columns are not read. A very long text is one row's work.
    """
    return per_text(docs, measure, OUT)
