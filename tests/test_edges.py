"""Hand-written edge rows (FIXTURES.md, 'Hand-written edge rows')."""

import json

import pytest
from pyspark.sql import functions as F

from qaspark.functions import replies as R
from qaspark.functions import text as T
from qaspark.operators import cases as K
from qaspark.operators import chat as CH
from qaspark.operators import compare as CMP
from qaspark.operators import split as S
from qaspark.operators import summary as SM
from qaspark.sources import io as IO

ITEM = '{"category":"c","question":"q","answer":"a"}'


def _items(spark, raw):
    df = spark.createDataFrame([(raw,)], "raw string")
    out = df.select(F.transform(R.extract_items("raw"), lambda v: F.to_json(v)).alias("i")).collect()[0]["i"]
    return out


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("[1] here [2]", []),
        ('{"a":"[1]","b":[%s]}' % ITEM, [ITEM.replace('{"category":"c","question":"q","answer":"a"}',
                                               '{"answer":"a","category":"c","question":"q"}')]),
        ('{"z":[1],"b":[2]}', ["1"]),
        ('{"a":[],"b":[3]}', []),
        ('{"question":"x"} x', []),
        ("[note] here: [%s]" % ITEM, []),
        ("3", []),
        ("null", []),
        ("", []),
        ("1,2", []),
        ("{'a':1}", []),
        ('{"a":1,"a":2}', []),
        ("Sure, here: [1] hope it helps", ["1"]),
        (ITEM, ['{"answer":"a","category":"c","question":"q"}']),
    ],
)
def test_extract_items_edges(spark, raw, expected):
    assert _items(spark, raw) == expected


def test_extract_items_mixed_elements(spark):
    items = _items(spark, '[%s, "question", 3]' % ITEM)
    assert items == ['{"answer":"a","category":"c","question":"q"}', '"question"', "3"]


def test_reply_items_reasons(spark):
    from qaspark.operators.corpus import reply_items

    rows = [
        (1, "c", "[%s]" % ITEM),
        (2, "c", "not json"),
        (3, "c", '[{"question": "q"}]'),
        (4, "c", '[{"question": " \\u00a0 ", "answer": "a"}]'),
        (5, "c", '["x"]'),
    ]
    df = spark.createDataFrame(rows, "id long, requested_category string, raw string")
    got = {r["id"]: r["reason"] for r in reply_items(df).collect()}
    assert got == {1: None, 2: "no_items", 3: "missing_answer", 4: "blank_question", 5: "not_object"}


def test_checkpoint_lines(spark):
    lines = [
        "not json",
        '{"idx": 5, "scores": {"A": 0.',
        '{"scores": {"A": 1.0}}',
        '{"idx": 2, "scores": null}',
        '{"idx": 4, "scores": {"A": 0.5, "B": "0.5", "C": null, "D": true}}',
        '{"idx": 7, "scores": {"A": 0.1}, "written_at": "2024-01-01T00:00:00"}',
        '{"idx": 7, "scores": {"A": 0.9}, "written_at": "2024-01-02T00:00:00"}',
    ]
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    entries = IO.parse_checkpoint(df)
    counted = sorted(r["idx"] for r in entries.collect())
    assert counted == [2, 4, 7, 7]  # duplicates="count": every line
    from qaspark.session import scratch_path

    path = scratch_path(spark, "ckpt-test")
    IO.append_checkpoint(df, path)
    latest = {r["idx"]: r["scores"] for r in IO.read_checkpoint(spark, path).collect()}
    assert latest[2] is None
    assert latest[4] == {"A": 0.5, "D": 1.0}
    assert latest[7] == {"A": 0.9}
    assert set(latest) == {2, 4, 7}


@pytest.mark.parametrize(
    "n,expected",
    [(0, (0, 0, 0)), (3, (3, 0, 0)), (6, (6, 0, 0)), (9, (6, 3, 0)), (11, (6, 5, 0)), (12, (6, 5, 1)),
     (37, (6, 5, 26)), (38, (6, 5, 27)), (40, (6, 5, 27))],
)
def test_split_quota_fill_order(spark, n, expected):
    rows = [(i, "g") for i in range(n)] + [(1000, "other")]
    df = spark.createDataFrame(rows, "id long, category string")
    sizes = {r["split"]: r["n"] for r in S.split_sizes(S.stratified_split(df).where("category = 'g'")).collect()}
    assert (sizes.get("golden_eval", 0), sizes.get("validation", 0), sizes.get("train", 0)) == expected


def test_to_text_and_flatten(spark):
    df = spark.createDataFrame([(None, ["a ", None, "", "b"], ["a", None, "b"])],
                               "s string, arr array<string>, lst array<string>")
    r = df.select(T.to_text("s", df.schema["s"].dataType).alias("s"),
                  T.to_text("arr", df.schema["arr"].dataType).alias("arr"),
                  T.flatten_list("lst").alias("lst")).collect()[0]
    assert (r["s"], r["arr"], r["lst"]) == ("", "a\nb", "a None b")


def test_strip_matches_python(spark):
    texts = ["\n a \t", " x　", " y ", "  ", "z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.strip_ws("t")).collect()]
    assert got == [t.strip() for t in texts]


def test_metric_delta_zero_base(spark):
    post = spark.createDataFrame([("M", 0.4, 0.5), ("N", 0.4, 0.5)], "metric string, avg_score double, pass_rate double")
    base = spark.createDataFrame([("M", 0.0, 0.0)], "metric string, avg_score double, pass_rate double")
    got = {r["metric"]: (r["delta"], r["relative_change"])
           for r in CMP.metric_delta(CMP.metric_join(post, base)).collect()}
    assert got == {"M": (0.4, 0.0), "N": (0.4, 0.0)}


@pytest.mark.parametrize(
    "d,label,reg",
    [(0.15, "SIGNIFICANT IMPROVEMENT", False), (0.1499, "MODERATE IMPROVEMENT", False),
     (0.05, "MODERATE IMPROVEMENT", False), (0.0499, "MARGINAL / FLAT", False),
     (-0.2, "MARGINAL / FLAT", True), (None, "MARGINAL / FLAT", False)],
)
def test_verdict(spark, d, label, reg):
    df = spark.createDataFrame([(d,)], "d double")
    r = df.select(CMP.verdict(F.col("d")).alias("v"), CMP.regressed(F.col("d")).alias("r")).collect()[0]
    assert (r["v"], r["r"]) == (label, reg)


def test_failed_cases(spark):
    rows = [(1, "A", None, "x"), (1, "B", None, "y"),        # all metrics raise -> failed
            (2, "A", 0.5, None), (2, "B", None, "y"),        # one raises -> not failed
            (3, "A", 0.5, None), (3, "B", 0.9, None)]        # none raises
    df = spark.createDataFrame(rows, "idx long, metric string, score double, error string")
    r = SM.failed_cases(df).collect()[0]
    assert (r["n_failed"], r["n_cases"]) == (1, 3)


def test_context_coverage(spark):
    rows = [("a", "c" if i < 8 else "") for i in range(10)] + [("b", "c" if i < 7 else "") for i in range(10)]
    df = spark.createDataFrame(rows, "g string, context string")
    got = {r["g"]: r["has_context"] for r in K.context_coverage(df, by=["g"]).collect()}
    assert got == {"a": True, "b": False}


def test_template_kind(spark):
    df = spark.createDataFrame([("<|turn>user x <start_of_turn>user",), ("<start_of_turn>user",), ("none",)], "t string")
    assert [r[0] for r in df.select(CH.template_kind("t")).collect()] == ["turn", "start_of_turn", None]


def test_training_plan(spark):
    df = spark.range(243)
    r = CH.training_plan(df).collect()[0]
    assert (r["total_steps"], r["warmup_steps"]) == (152, 5) == CH.plan_numbers(243)


def test_token_estimate_admissible(spark):
    lengths = [0, 3, 4, 12704, 12708]
    df = spark.createDataFrame([("x" * n,) for n in lengths], "t string")
    est = [r[0] for r in df.select(T.token_estimate("t")).collect()]
    assert est == [1024, 1024, 1025, 4200, 4201]
    from qaspark.operators.score import never_admissible

    assert never_admissible(df, "t").count() == 1


def test_detect_columns_first_row_only(spark):
    df = spark.createDataFrame([(1, "", "q1", "a1", "c"), (2, "i2", "q2", "a2", "")],
                               "idx long, input string, question string, output string, context string")
    assert K.detect_columns(df, order="idx") == ("question", "output", "context")


def test_require_rows_raises(spark):
    df = spark.createDataFrame([(1, "q"), (2, None)], "id long, question string")
    assert IO.require_rows(df, F.col("id") > 0, "bad id").count() == 2
    with pytest.raises(Exception, match="null question"):
        IO.require_rows(df, F.col("question").isNotNull(), "null question").select("id").collect()
    with pytest.raises(ValueError):
        IO.require_columns(df, "id", "answer")


def test_pending_cases_retry_flag(spark):
    cases = spark.range(5).withColumnRenamed("id", "idx")
    done = spark.createDataFrame([(0, {"A": 0.5}), (1, {}), (2, None)], "idx long, scores map<string,double>")
    assert sorted(r["idx"] for r in K.pending_cases(cases, done).collect()) == [3, 4]
    assert sorted(r["idx"] for r in K.pending_cases(cases, done, retry_failed=True).collect()) == [1, 2, 3, 4]


def test_checkpoint_idx_forms(spark):
    lines = ['{"idx": 3, "scores": {}}', '{"idx": 4.0, "scores": {}}', '{"idx": 5.5, "scores": {}}',
             '{"idx": "6", "scores": {}}', '{"idx": true, "scores": {}}', '[1, 2]']
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    assert sorted(r["idx"] for r in IO.parse_checkpoint(df).collect()) == [3, 4]


def test_last_line_of_a_log_wins(spark, tmp_path):
    """Without write times: later commits, later files, later lines; a commit
    that is written again replaces itself."""
    line = lambda i, s: (f'{{"idx": {i}, "scores": {{"A": {s}}}}}',)
    commits = [[line(i % 50, i) for i in range(400)], [line(i % 30, 1000 + i) for i in range(90)], [line(3, 7)]]
    path = str(tmp_path / "log")
    for n, rows in enumerate(commits):
        for _ in range(2):
            # 13 commits' worth of numbers, so that 10 doesn't come before 2
            IO.append_checkpoint(spark.createDataFrame(rows, "value string").repartitionByRange(3, F.monotonically_increasing_id()) if n == 1 else
                                 spark.createDataFrame(rows, "value string").coalesce(1), path, 2 + 8 * n)
    want = {}
    for n in (0, 2):
        for (text,) in commits[n]:
            e = json.loads(text)
            want[e["idx"]] = e["scores"]
    got = {r["idx"]: r["scores"] for r in IO.read_checkpoint(spark, path).collect()}
    for i in range(50):
        if i == 3 or i >= 30:
            assert got[i] == want[i]
        else:
            assert got[i]["A"] >= 1000
    assert IO.read_checkpoint(spark, path, "count").count() == 491


def test_lines_of_one_appended_file_keep_their_order(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text("".join(f'{{"idx": {i % 7}, "scores": {{"A": {i}}}}}\n' for i in range(900)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = {r["idx"]: r["scores"]["A"] for r in IO.read_checkpoint(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i % 7: float(i) for i in range(893, 900)}


def test_lenient_replies_equal_python(spark):
    texts = [
        '[{"a": 1, "a": 2}]', '{"l": [1], "m": [2], "l": 3}', '{"l": 0, "m": [2], "l": [3]}', "[NaN, -Infinity, Infinity]", '[{"a": NaN}]',
        '["NaN", "x \\" NaN", "\\\\", NaN]', 'say NaN [{"q": Infinity}] "x', "NaN", "[nan]", "[+Infinity]", "[xNaN]", '{"a": {"b": 1, "b": [NaN]}}',
        '["a NaN, [NaN] b", {"c": "Infinity"}]', '[{"a": [1], "a": "Infinity"}, NaN]', "[1NaN]", '{"NaN": [NaN]}', "[-NaN]", "[]", "", '{"a": "[1]", "b": [2]}',
    ]

    def plain(x):
        if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf"))):
            return {"inf": "Infinity", "-inf": "-Infinity"}.get(str(x), "NaN")
        return [plain(y) for y in x] if isinstance(x, list) else {k: plain(y) for k, y in x.items()} if isinstance(x, dict) else x

    def python(text):
        try:
            r = json.loads(text)
            if isinstance(r, list):
                return r
            return next((v for v in r.values() if isinstance(v, list)), [r]) if isinstance(r, dict) else []
        except json.JSONDecodeError:
            a, b = text.find("["), text.rfind("]") + 1
            try:
                r = json.loads(text[a:b]) if a != -1 and b > a else []
                return r if isinstance(r, list) else []
            except json.JSONDecodeError:
                return []

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    old = spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false")
    with R.repeated_keys(spark):
        got = df.select("i", F.transform(R.extract_items("t"), lambda v: F.to_json(v)).alias("j"))
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == old
    for r in got.collect():
        assert [json.loads(j) for j in r["j"]] == plain(python(texts[r["i"]])), texts[r["i"]]
