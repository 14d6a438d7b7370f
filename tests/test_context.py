import pytest
from pyspark.sql import functions as F

from spanloom import attach_trace_context
from spanloom.functions.traceparent import comment_traceparent, is_valid_traceparent
from tests.data import TRACEPARENT, executions

TRACE_ID, PARENT_ID = TRACEPARENT.split("-")[1:3]

COMMENTS = {
    "/* m.tp=v1 */ SELECT": "v1",
    "/*m.tp=v1*/ SELECT": "v1",
    "SELECT /* a /* b */ m.tp=v1 */": "v1",
    "/* a /* m.tp=inner */ m.tp=outer */": "inner",
    "SELECT /* a */ , m.tp=v1": None,
    "m.tp=v0 /* a */ /* m.tp=v1 */": "v1",
    "/* k=1 m.tp=v1 m.tp=v2 */": "v1",
    "/* m.tp=v1": "v1",
    "*/ m.tp=v0 /* m.tp=v1 */": "v1",
    "/* xm.tp=v1 */": None,
    "/* -m.tp=v1\tm.tp=v2 */": "v2",
    "/* a\nm.tp=v1\r\nb */": "v1",
    "/* m.tp= */": "",
    "/* mxtp=v1 */": None,
    "/* m.tp=a*b*/": "a*b",
    "'/* m.tp=v1 */'": "v1",
    "SELECT 1": None,
    "": None,
    None: None,
}


def test_marked_words_in_comments(spark):
    df = spark.createDataFrame([(t,) for t in COMMENTS], "text STRING")
    rows = df.select("text", comment_traceparent(F.col("text"), "m.tp=").alias("found")).collect()
    assert {r.text: r.found for r in rows} == COMMENTS


def test_whole_text_is_searched(spark):
    filler, value = "x * " * 500_000, "v" * 1_000_000
    df = spark.createDataFrame([(f"{filler}/* a {filler} m.tp={value} */",)], "text STRING")
    assert df.select(comment_traceparent(F.col("text"), "m.tp=")).first()[0] == value


VALID = {
    TRACEPARENT: True,
    TRACEPARENT[:-2] + "ff": True,
    TRACEPARENT.upper(): False,
    TRACEPARENT + "-00": False,
    TRACEPARENT + "\n": False,
    " " + TRACEPARENT: False,
    "01" + TRACEPARENT[2:]: True,
    "01" + TRACEPARENT[2:] + "-more": True,
    "01" + TRACEPARENT[2:] + "more": False,
    "ff" + TRACEPARENT[2:]: False,
    f"00-{'0' * 32}-{PARENT_ID}-01": False,
    f"00-{TRACE_ID}-{'0' * 16}-01": False,
    f"00-{TRACE_ID}-{PARENT_ID}": False,
    "garbage": False,
    "": False,
    None: False,
}


def test_traceparent_grammar(spark):
    df = spark.createDataFrame([(v,) for v in VALID], "v STRING")
    rows = df.select("v", is_valid_traceparent(F.col("v")).alias("valid")).collect()
    assert {r.v: r.valid for r in rows} == VALID


def context_of(spark, orphan_trace="zero", **fields):
    df = attach_trace_context(executions(spark, fields), "m.tp=", orphan_trace)
    row = df.first()
    return row.has_context, row.trace_id, row.parent_span_id


NO_CONTEXT = (False, "0" * 32, "0" * 16)


def test_setting_wins_over_comment(spark):
    commented = f"/* m.tp={TRACEPARENT} */"
    other = f"00-{'a' * 32}-{'b' * 16}-00"
    assert context_of(spark, source_text=commented) == (True, TRACE_ID, PARENT_ID)
    assert context_of(spark, source_text=commented, traceparent_setting=other) == (
        True,
        "a" * 32,
        "b" * 16,
    )
    assert context_of(spark, source_text=commented, traceparent_setting="bad") == NO_CONTEXT
    assert context_of(spark, source_text=None) == NO_CONTEXT


def test_orphans_can_get_a_trace_of_their_own(spark):
    valid, trace_id, parent = context_of(spark, "derive", query_id=5)
    assert (valid, parent) == (False, "0" * 16)
    assert trace_id == "e4da3b7fbbce2345d7772b0674a318d5"
    with pytest.raises(ValueError):
        context_of(spark, "other")
