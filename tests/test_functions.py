"""Tables of cases for the column expressions."""

import pytest
from pyspark.sql import functions as F

from tideline.functions.arn import arn_error, arn_format, arn_parse, arn_resource, bucket_arn, log_resource
from tideline.functions.attributes import (
    event_source, event_type, ext_attr_name, key_subject, object_event_type, queue_name, seconds_ms, spec_event_type,
    split_list, url_path)
from tideline.functions.duration import duration_error, duration_format, duration_parse
from tideline.functions.predicates import (
    polling_interval, valid_query_name, valid_region, valid_source_arn, valid_visibility_timeout)
from tideline.functions.reasons import failure_reason


def apply(spark, values, fn, schema="x string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("x"))).collect()]


def test_arn(spark):
    texts = ["arn:cloud-x:lake:north-9:0042:box/7:blue", "arn:::north-9::", "arn:cloud-x:", "urn:cloud-x:", "", None]
    assert apply(spark, texts, arn_error) == [
        None, None, "not enough sections", "invalid prefix", "invalid prefix", "invalid prefix"]
    parsed = apply(spark, texts, arn_parse)
    assert tuple(parsed[0]) == ("cloud-x", "lake", "north-9", "0042", "box/7:blue")
    assert tuple(parsed[1]) == ("", "", "north-9", "", "")
    assert parsed[2:] == [None] * 4
    assert apply(spark, texts[:2], lambda x: arn_format(arn_parse(x))) == texts[:2]
    assert apply(spark, [texts[0], "x"], lambda x: bucket_arn(arn_parse(x))) == ["arn:cloud-x:lake:::box/7:blue", None]


def test_arn_resource(spark):
    texts = ["table/some-value", "table/a/index/b", "table", "", "other/some-value", "stream/x"]
    assert apply(spark, texts, lambda x: arn_resource(x, "table")) == [["some-value"], None, None, None, None, None]


def test_log_resource(spark):
    texts = [
        "log-group:/shop/cart:*", "log-group:/shop/cart:log-stream:web/3",
        "log-group:/shop/cart", "nothing", "log-group", "log-group:a:log-group:b"]
    assert [tuple(r) for r in apply(spark, texts, log_resource)] == [
        ("/shop/cart", ""), ("/shop/cart", "web/3"), ("/shop/cart", ""), ("", ""), ("", ""),
        ("b", "")]


S = 1_000_000_000


@pytest.mark.parametrize("text, nanos, error", [
    ("5m", 300 * S, None), ("7m20s", 440 * S, None), ("1h", 3600 * S, None), ("1.5h", 5400 * S, None),
    ("-1.5s", -1_500_000_000, None), ("+3ms", 3_000_000, None), ("0", 0, None), (".5s", 500_000_000, None),
    ("1us", 1000, None), ("1µs", 1000, None), ("2μs", 2000, None), ("7ns", 7, None), ("1.s", S, None),
    ("2562047h47m16.854775807s", 9223372036854775807, None), ("2562048h", None, "invalid duration"),
    ("5", None, "missing unit"), ("5m1", None, "missing unit"), ("8oz", None, "unknown unit"),
    ("1m2d", None, "unknown unit"), ("", None, "invalid duration"), ("abc", None, "invalid duration"),
    (".s", None, "invalid duration"), (None, None, "invalid duration"),
])
def test_duration(spark, text, nanos, error):
    assert apply(spark, [text], duration_parse) == [nanos]
    assert apply(spark, [text], duration_error) == [error]


def test_duration_format(spark):
    cases = {
        0: "0s", 1: "1ns", 1100: "1.1µs", 2_200_000: "2.2ms", 3_300_000_000: "3.3s", 300 * S: "5m0s",
        440 * S: "7m20s", 3600 * S: "1h0m0s", 5401 * S + 1: "1h30m1.000000001s", -S: "-1s"}
    assert apply(spark, list(cases), duration_format, "x bigint") == list(cases.values())


def test_names(spark):
    assert apply(spark, ["Harbour.North.Pier", "Wet_Rope", "mât-1"], ext_attr_name) == [
        "sqsmsgharbournorthpier", "sqsmsgwetrope", "sqsmsgmt1"]
    assert apply(spark, ["ObjectRemoved:DeleteMarkerCreated", "ReducedRedundancyLostObject"], object_event_type) == [
        "objectremoved", "reducedredundancylostobject"]
    assert apply(spark, ["s3:ObjectCreated:*", "Replication:x"], spec_event_type) == ["objectcreated", "replication"]
    assert apply(spark, ["x"], lambda x: event_type("sqs", x)) == ["com.amazon.sqs.x"]
    assert apply(spark, ["b"], queue_name) == ["s3-events_b"]
    assert apply(spark, ["n"], lambda x: url_path(F.lit("ns"), x)) == ["/ns/n"]
    assert apply(spark, ["push,pull_request"], split_list) == [["push", "pull_request"]]
    assert apply(spark, [["name", "id"], [], None], key_subject, "x array<string>") == ["id,name", "", ""]
    assert apply(spark, ["2024-01-01 00:00:01.999"], lambda x: seconds_ms(x.cast("timestamp"))) == [1704067201000]


def test_event_source(spark):
    arn = "arn:aws:s3:us-east-1:123456789012:bucket"
    sources = apply(spark, ["s3", "sqs", "cloudwatch"], lambda k: event_source(
        k, F.lit(arn), arn_parse(F.lit(arn)), F.lit("ns"), F.lit("Name"), "io.example"))
    assert sources == ["arn:aws:s3:::bucket", arn, "io.example.awscloudwatchsource.ns.Name"]


def test_predicates(spark):
    arns = {
        "arn:aws:sqs:us-east-1:123456789012:q": True, "arn:aws-cn:sqs:cn-north-1:123456789012:q": True,
        "arn:aws-us-gov:sqs:us-gov-east-1:123456789012:q": True, "arn:aws:sqs:us-east-1:12345:q": False,
        "arn:aws:sns:us-east-1:123456789012:q": False, None: False}
    assert apply(spark, list(arns), lambda a: valid_source_arn(F.lit("sqs"), a)) == list(arns.values())
    assert apply(spark, ["arn:aws:s3:us-east-1:123456789012:Bad"], lambda a: valid_source_arn(F.lit("s3"), a)) == [False]
    assert apply(spark, ["us-east-1", "useast1"], valid_region) == [True, False]
    assert apply(spark, ["a_1", "1a", "a" * 256], valid_query_name) == [True, False, False]
    assert apply(spark, [None, 0, 1_999_999_999, 12 * 3600 * S, 12 * 3600 * S + 1, -1], valid_visibility_timeout, "x bigint") == [
        None, 0, 1, 43200, None, None]
    assert apply(spark, [None, 0, -5, 7], polling_interval, "x bigint") == [300 * S, 300 * S, 300 * S, 7]


@pytest.mark.parametrize("reason, message, exact", [
    ("CrashLoopBackOff", "back-off", "AppRuntimeFailure"),
    ("RevisionFailed", "Revision failed: Container failed with: panic", "AppRuntimeFailure"),
    ("ErrImagePull", "", "BadContainerImage"),
    ("RevisionFailed", 'Unable to fetch image "x": not found', "BadContainerImage"),
    ("CreateContainerConfigError", 'secret "db-login" not found', "MissingSecret"),
    ("CreateContainerError", 'could not start: configMap "a" not found.', "MissingConfigMap"),
    ("RevisionFailed", 'x: secret "a" not found', "MissingSecret"),
    ("CreateContainerError", '"a" not found', "CreateContainerError"),
    ("CreateContainerError", ' "a" not found', "CreateContainerError"),
    ("CreateContainerError", 'secret:"a" not found', "CreateContainerError"),
    ("CreateContainerError", 'secret "a" not found..', "CreateContainerError"),
    ("CreateContainerError", 'secret "' + "a" * 251 + '" not found', "MissingSecret"),
    ("CreateContainerError", 'secret "' + "a" * 252 + '" not found', "CreateContainerError"),
    ("Pending", 'secret "a" not found', "Pending"),
])
def test_failure_reason(spark, reason, message, exact):
    assert apply(spark, [message], lambda m: failure_reason(F.lit(reason), m)) == [exact]
