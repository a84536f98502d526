import base64

from pyspark.sql import types as T

from tabmill.sources import files, instances, messages

NAMES = ["Time", "Amount", "V1"]
POSITIONS = ["Time", "V1", "Amount"]


def parse(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "line int, value string")
    good, bad = instances.parse_instances(df, NAMES, POSITIONS, keep=["line"])
    return (sorted((r.line, r.Time, r.Amount, r.V1) for r in good.collect()),
            sorted((r.line, r.reason) for r in bad.collect()))


def test_every_shape(spark):
    good, bad = parse(spark, [
        '{"Time": 1, "Amount": 2.5, "V1": -0.5}',
        "{'Time': 1, 'Amount': 2.5, 'V1': -0.5}",
        '{"Time": "1", "Amount": "2.5", "V1": "-0.5"}',
        '{"dense_input": [1, -0.5, 2.5]}',
        '{"instances": [1, -0.5, 2.5]}',
        '[[1, -0.5, 2.5], [2, -0.5, 2.5]]',
        '{"Time": [1, 2], "Amount": [2.5, 3.5], "V1": [-0.5,-0.5]}',
        '[{"Time": 1, "Amount": 2.5, "V1": -0.5},',
        '{"Time": 1, "Amount": 2.5, "V1": -0.5},',
        '{"Time": 1, "Amount": 2.5, "V1": -0.5}]',
        "[{'Time': 1, 'Amount': 2.5, 'V1': -0.5}]",
        '', '   '])
    row = (1.0, 2.5, -0.5)
    assert good == [(i, *row) for i in range(6)] + [(5, 2.0, 2.5, -0.5), (6, *row), (6, 2.0, 3.5, -0.5)] + [
        (i, *row) for i in range(7, 11)]
    assert bad == []


def test_dead_letters(spark):
    good, bad = parse(spark, [
        '"error": "Matrix size-incompatible"',
        '# warning',
        '{"Time": 1, "Amount": 2.5}',
        '{"Time": 1, "Amount": "much", "V1": 0}',
        '{"dense_input": [1, 2]}',
        '[[1, 2, 3], [1, 2]]',
        '{"Time": [1, 2], "Amount": [2.5], "V1": [0, 0]}',
        '{"Time": 1, "Amount": 2.5, "V1": '])
    assert good == [(5, 1.0, 3.0, 2.0), (6, 1.0, 2.5, 0.0)]
    assert bad == [(0, "not an instance"), (1, "not an instance"), (2, "not a number"), (3, "not a number"),
                   (4, "wrong length"), (5, "wrong length"), (6, "not a number"), (7, "not an instance")]


def test_spaced_fields(spark):
    lines = ["18.0   8   307.0      130.0\t\"a car\"", " 15.0 8  ?  165.0\tx", "", "9. 4 1e2 ?"]
    schema = T.StructType.fromDDL("mpg double, cylinders int, displacement double, power double")
    got = files.spaced_fields(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    assert [tuple(r) for r in got] == [(18.0, 8, 307.0, 130.0), (15.0, 8, None, 165.0), (9.0, 4, 100.0, None)]


def test_prediction_lines(spark):
    lines = ['{"instance": {"id": 1}, "prediction": {"value": 2.5, "lower": 1}}',
             '{"instance": {"id": 2}, "prediction": [3.5, 9]}', '{"instance": {"id": 3}, "prediction": []}']
    schema = T.StructType.fromDDL("id long")
    got = files.parse_predictions(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (2, 3.5), (3, None)]


def test_messages(spark):
    b64 = lambda b: base64.b64encode(b).decode()
    rows = [(1, b64('{"model_config": "é.json"}'.encode())), (2, "%%%"), (3, b64(b"\xff\xfe{")), (4, b64(b"[]")), (5, None)]
    got = messages.decode_messages(spark.createDataFrame(rows, "id int, data string"),
                                   T.StructType.fromDDL("model_config string")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "é.json", True)] + [(i, None, False) for i in (2, 3, 4, 5)]


def test_decimal_load_replaces(spark, tmp_path):
    from decimal import Decimal
    schema = T.StructType.fromDDL("Sex string, Length decimal(38,9)")
    for value in ("0.455", "0.35"):
        (tmp_path / "a.csv").write_text(f"Sex,Length\nM,{value}\n")
        files.load_csv_table(spark, str(tmp_path / "a.csv"), schema, "loaded_part", str(tmp_path / "table"))
        assert [tuple(r) for r in spark.read.table("loaded_part").collect()] == [("M", Decimal(value))]
    spark.sql("drop table loaded_part")


def test_an_array_as_long_as_the_names_but_not_the_positions_is_wrong(spark):
    lines = spark.createDataFrame([('{"dense_input": [1, 2]}',), ('{"dense_input": [0, 1, 2]}',)], "value string")
    got = {r.value: (r.row, r.reason) for r in instances.route(lines, ["a", "b"], ["x", "a", "b"]).collect()}
    assert got['{"dense_input": [1, 2]}'][1] == "wrong length"
    assert got['{"dense_input": [0, 1, 2]}'] == ([1.0, 2.0], None)
