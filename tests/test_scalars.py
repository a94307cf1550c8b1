import fnmatch
import hashlib
import json
import random

from pyspark.sql import functions as F

from tidewatch.functions import scalars as S


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_or_default(spark):
    assert column(spark, [None, "", " ", "x"], S.or_default("v", "d")) == ["d", "d", " ", "x"]


def test_num_default(spark):
    assert column(spark, [None, 1.5], S.num_default("v"), "double") == [0.0, 1.5]


def test_severity_rank(spark):
    given = ["info", "WARN", "warning", "error", "Critical", "debug", None]
    assert column(spark, given, S.severity_rank("v")) == [0, 1, 1, 2, 3, 0, 0]


def test_decisions(spark):
    given = [" approve", "Approved", "yes", "Y", "deny", "DENIED", "reject", "rejected\n", "no", "n", "maybe", "", None]
    assert column(spark, given, S.normalize_decision("v")) == ["APPROVE"] * 4 + ["DENY"] * 6 + [None] * 3


def test_glob_matches_like_a_shell(spark):
    names = ["payments", "pay", "db-1", "db-2", "a]b", "a^b", "Db-1", "db.1", "x&&y", ""]
    for pattern in ["*", "pay*", "db-?", "db-[12]", "db-[!2]", "a[]]b", "a[^]b", "db.1", "*b", "[", "x[&]*", "?"]:
        want = [fnmatch.fnmatchcase(n, pattern) for n in names]
        assert column(spark, names, S.glob_match("v", pattern)) == want, pattern


def test_render_target(spark):
    given = ["{service}", "svc-{service}-x", "fixed", "{other}", "{service}{", "{}"]
    want = ["pay", "svc-pay-x", "fixed", "pay", "pay", "pay"]
    assert column(spark, given, S.render_target("v", F.lit("pay"))) == want


def test_canonical_json_and_id(spark):
    record = {"b": 'say "hi" \\ ü', "a": 7, "d": None, "c": {"y": 1, "x": [1, 2]}}
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    raw = json.dumps(record["c"], sort_keys=True, separators=(",", ":"))
    expr = S.canonical_json(
        {"b": F.lit(record["b"]), "a": F.lit(7), "d": F.lit(None).cast("string"), "c": F.lit(raw)}, raw=("c",)
    )
    df = spark.range(1).select(expr.alias("j"), S.stable_id(expr).alias("h"))
    assert tuple(df.first()) == (text, hashlib.sha256(text.encode()).hexdigest()[:24])


def test_parse_ts(spark):
    given = [
        "2024-01-01T00:00:01Z", "2024-01-01T01:00:01.500000+01:00", "1704067201000", "1704067201", "", None, "soon"
    ]
    got = column(spark, given, F.unix_micros(S.parse_ts("v")))
    one = 1_704_067_201_000_000
    assert got == [one, one + 500_000, one, one, None, None, None]


def test_round_exact_equals_ieee_rounding(spark):
    rng = random.Random(5)
    values = [2.675, 4.40375, 0.02875, 0.03125, 0.09375, 1.00005, 12.34565, 0.0, 80.00005, 1e-9, 1e18 / 7, 4e15 / 3, -2.675]
    values += [round(rng.random() * 500, 2) / rng.randrange(1, 100) for _ in range(3000)]
    got = column(spark, values, S.round_exact("v", 4), "double")
    assert got == [round(v, 4) for v in values]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (1.0, -1.0)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [0.0, 0.3333, 0.0]
