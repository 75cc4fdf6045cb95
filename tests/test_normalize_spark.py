"""The Spark column expression equals the per-value Python rule, row by row."""

import json

from conftest import rows


from tessera.functions.normalize import is_serialized, normalize_column
from tessera.functions.phpserial import php_to_json
from test_phpserial import GOLDEN

EXTRA = [
    "i:0;", "i:-0;", "i:123456789012345678;", "i:1234567890123456789;", "b:2;", "b:-0;", "b:007;",
    "N;junk", "n;", "I:5;", "i:5", "i:;", "b:;", "d:.5;", "s:1:\"é\";", "s:2:\"é\";",
    'a:1:{s:4:"name";s:6:"日本";}', "x:1;", " i:1;", "i:1;i:2;",
]


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


def test_expression_matches_python(spark):
    values = [t for t, _ in GOLDEN] + EXTRA
    out = normalize_column(_frame(spark, values), "value").orderBy("id").collect()
    for (text, row) in zip(values, out):
        assert row.value == php_to_json(text), text


def test_gate_is_case_sensitive(spark):
    df = _frame(spark, ["a:0:{}", "A:0:{}", "N;", "N:", "x:1", "O:1:\"a\":0:{}", "C:1"])
    got = [r[0] for r in df.orderBy("id").select(is_serialized("value")).collect()]
    assert got == [True, False, True, False, False, True, False]


def test_options(spark):
    df = spark.createDataFrame([(1, "i:5;", 1), (2, "i:6;", 0), (3, None, 1), (4, "N;", None), (5, "a:0:{}", None)],
                               "id int, value string, flag int")
    out = normalize_column(df, "value", flag_col="flag", keep_original=True, null_as_empty=False)
    got = {r.id: (r.value, r.value_original) for r in out.collect()}
    assert got == {1: ("5", "i:5;"), 2: ("i:6;", "i:6;"), 3: (None, None), 4: ("N;", "N;"),
                   5: ("a:0:{}", "a:0:{}")}
    assert out.columns == ["id", "value", "flag", "value_original"]


def test_strict_json(spark):
    df = _frame(spark, ["d:NAN;", "a:1:{i:0;d:INF;}"])
    got = [r.value for r in normalize_column(df, "value", strict_json=True).orderBy("id").collect()]
    assert got == ["null", '{"0": null}']
    for g in got:
        json.loads(g)


def test_udf_argument_is_gated(spark):
    # Python only sees values the JVM could not settle natively.
    df = normalize_column(_frame(spark, ["plain", "i:1;", 'a:1:{i:0;N;}']), "value")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "CASE WHEN" in plan


def test_native_fast_paths_match_python_on_fuzzed_text(spark):
    # Strings close to the natively handled forms (N;, i:<n>;, b:<n>;):
    # whatever path a value takes, the result equals the Python rule.
    import random
    rng = random.Random(7)
    alphabet = "ibdNsa:;-+0123456789 _{}\"é"
    values = []
    for _ in range(3000):
        head = rng.choice(["i:", "b:", "N;", "d:", "s:", "a:", "I:", "n;", ""])
        body = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24)))
        values.append(head + body)
    values += [f"i:{'9' * n};" for n in range(15, 25)] + [f"b:{'-' if n % 2 else ''}{'0' * n};" for n in range(1, 20)]
    out = normalize_column(_frame(spark, values), "value").orderBy("id").collect()
    for text, row in zip(values, out):
        assert row.value == php_to_json(text), text


FLAT = ['a:0:{}', 'a:1:{i:0;s:1:"x";}', 'a:3:{s:1:"k";i:-5;s:2:"on";b:1;i:7;N;}', 'a:1:{s:3:"a;b";s:4:"}i:1";}', 'a:2:{i:0;b:0;i:-12;s:0:"";}']
OTHER = [None, '', 'plain', 'i:5;', 'a:1:{i:0;a:0:{}}', 'a:1:{i:0;s:3:"a"b";}', 'a:1:{i:0;s:2:"é";}', 'a:1:{i:0;d:0.5;}', 'a:2:{i:0;N;s:1:"0";N;}', 'a:1:{i:0;s:2:"x";}',
         'a:2:{i:0;N;}', 'a:1:{i:0;N;}trailing}', 'a:1:{i:05;N;}', 'a:1:{b:1;N;}', 'a:1:{N;N;}', 'a:01:{i:0;N;}', 'a:1:{i:0;s:1:"\\\\";}', 'a:1:{i:0;i:-0;}', 'a:1:{i:0;s:01:"x";}',
         'a:1:{i:0;N;x}', 'a:1:{i:9999999999999999999;N;}', 'a:1:{i:0;O:1:"a":0:{}}', 'a:1:{i:0;s:1:"\t";}']


def test_flat_arrays_without_python(spark):
    from tessera.functions.normalize import flat_array_json
    from tessera.functions.phpserial import php_to_json
    df = spark.createDataFrame([(v,) for v in FLAT + OTHER], "v string").select("v", flat_array_json("v").alias("j"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for r in df.collect():
        assert r["j"] == (php_to_json(r["v"]) if r["v"] in FLAT else None), r["v"]


def test_flat_arrays_are_what_the_parser_gives(spark):
    import random
    from tessera.functions.normalize import flat_array_json
    from tessera.functions.phpserial import php_to_json
    draw = random.Random(2)
    atoms = ['i:1;', 'i:-20;', 'b:1;', 'N;', 's:1:"a";', 's:2:"ab";', 's:3:"a;}";', 's:0:"";', 'd:1;', 'a:0:{}', 'i:1', 's:2:"a";', 'x', '"', '}', 's:1:"1";']
    texts = ["a:%d:{%s}" % (draw.randint(0, 3), "".join(draw.choice(atoms) for _ in range(draw.randint(0, 6)))) for _ in range(3000)]
    texts += ["a:%d:{%s}" % (n, "".join(f'i:{k};' + draw.choice(atoms[:8]) for k in range(n))) for n in range(1, 9) for _ in range(20)]
    got = spark.createDataFrame([(t,) for t in texts], "v string").select("v", flat_array_json("v").alias("j")).collect()
    assert sum(r["j"] is not None for r in got) > 160
    assert all(r["j"] is None or r["j"] == php_to_json(r["v"]) for r in got)


def test_the_native_path_changes_nothing(spark):
    df = spark.createDataFrame([(v, k % 2) for k, v in enumerate(FLAT + OTHER)], "value string, flag int").selectExpr("*", "'x' AS _flat")
    for kw in ({}, {"strict_json": True}, {"flag_col": "flag"}, {"null_as_empty": False, "keep_original": True}):
        assert rows(normalize_column(df, native_flat=True, **kw)) == rows(normalize_column(df, **kw))


def test_long_texts_are_parsed_in_small_slices(spark, monkeypatch):
    import pyarrow as pa

    from tessera.functions import normalize
    texts = [None, "s:3:\"abc\";", "é" * 40, None, "x" * 90, "", "s:1:\"a\";"]
    monkeypatch.setattr(normalize, "SLICE_BYTES", 64)
    cut = [s.to_pylist() for s in normalize._slices(pa.array(texts, pa.string()))]
    assert cut == [[None, "s:3:\"abc\";"], ["é" * 40], [None], ["x" * 90], ["", "s:1:\"a\";"]]
    assert [s.to_pylist() for s in normalize._slices(pa.array([], pa.string()))] == [[]]
    monkeypatch.undo()
    # Several slices in one Arrow batch: every row has its own result.
    rows = spark.range(12).selectExpr("id", "'s:' || (1000000 + id) || ':\"' || repeat('y', CAST(1000000 + id AS int)) || '\";' AS value").coalesce(1)
    got = normalize.normalize_column(rows, "value").selectExpr("id", "length(value) AS n").collect()
    assert sorted(map(tuple, got)) == [(k, 1000002 + k) for k in range(12)]
