"""Source shapes derived from the test tables by projection.

Each function takes ``(spark, sf_dir)`` and keeps every row of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ACCOUNT = "123456789012"
QUEUE_ARN = f"arn:aws:sqs:us-east-1:{ACCOUNT}:shop"
STREAM_ARN = f"arn:aws:kinesis:us-east-1:{ACCOUNT}:stream/clicks"
TABLE_ARN = f"arn:aws:dynamodb:us-east-1:{ACCOUNT}:table/orders"
LOGS_ARN = f"arn:aws:logs:us-east-1:{ACCOUNT}:log-group:shop:*"
DB_ARN = f"arn:aws:rds:us-east-1:{ACCOUNT}:db:shop"
REPO_ARN = f"arn:aws:codecommit:us-east-1:{ACCOUNT}:shop"
IDENTITY_ARN = f"arn:aws:cognito-identity:us-east-1:{ACCOUNT}:identitypool/us-east-1:pool"
POOL_ARN = f"arn:aws:cognito-idp:us-east-1:{ACCOUNT}:userpool/us-east-1_pool"
TOPIC_ARN = f"arn:aws:sns:us-east-1:{ACCOUNT}:topic"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table with an instant instead of a zone-less time."""
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def text(name: str) -> Column:
    return F.col(name).cast("string")


def numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def queue_messages(spark: SparkSession, sf: str) -> DataFrame:
    def attribute(kind: str, value: Column | None, binary: Column | None = None) -> Column:
        absent = F.lit(None).cast("string")
        return F.struct(
            F.lit(None).cast("array<string>").alias("BinaryListValues"),
            (binary if binary is not None else absent).alias("BinaryValue"),
            F.lit(kind).alias("DataType"),
            F.lit(None).cast("array<string>").alias("StringListValues"),
            (value if value is not None else absent).alias("StringValue"))

    common = F.create_map(
        F.lit("Event.Type"), attribute("String", F.col("event_type")),
        F.lit("Amount"), attribute("Number", text("value")),
        F.lit("Raw_Blob"), attribute("Binary.x", None, F.base64("props")))
    # a second attribute with the same name once renamed
    twin = F.create_map(F.lit("amount_"), attribute("String", text("user_id")))
    return events(spark, sf).select(
        text("event_id").alias("MessageId"), numbered("r-", F.col("event_id")).alias("ReceiptHandle"),
        F.col("props").alias("Body"), F.md5("props").alias("MD5OfBody"),
        F.lit(None).cast("string").alias("MD5OfMessageAttributes"),
        F.create_map(F.lit("SentTimestamp"), F.unix_millis("ts").cast("string")).alias("Attributes"),
        F.when(F.col("event_id") % 2 == 0, F.map_concat(common, twin)).otherwise(common).alias("MessageAttributes"),
        F.col("ts").alias("SentTimestamp"))


def object_messages(spark: SparkSession, sf: str) -> DataFrame:
    """A message per line item with one to three records, or one of the other bodies by order number."""
    name = (
        F.when(F.col("l_returnflag") == "A", "ObjectCreated:Put")
        .when(F.col("l_returnflag") == "N", "ObjectRemoved:DeleteMarkerCreated")
        .otherwise("ObjectRestore:Post"))
    bucket = (F.col("l_suppkey") % 10).cast("string")

    def record(i: Column) -> Column:
        return F.concat(
            F.lit('{"awsRegion":"us-east-1",'),
            F.when(F.col("l_orderkey") % 20 == 7, "").otherwise(F.concat(F.lit('"eventName":"'), name, F.lit('",'))),
            F.lit('"s3":{"bucket":{"arn":"arn:aws:s3:::bucket-'), bucket, F.lit('","name":"bucket-'), bucket,
            F.lit('"},"object":{"key":"'), F.concat_ws("/", text("l_orderkey"), text("l_linenumber"), i.cast("string")),
            F.lit('","size":'), F.col("l_quantity").cast("bigint").cast("string"), F.lit("}}}"))

    records = F.transform(F.sequence(F.lit(1), 1 + F.col("l_linenumber") % 3), record)
    kind = F.col("l_orderkey") % 20
    body = (
        F.when(kind == 0, F.concat(F.lit("hello "), text("l_partkey")))
        .when(kind == 1, '{"Records":[]}')
        .when(kind == 2, F.concat(F.lit('{"Service":"Amazon S3","Event":"s3:TestEvent","Bucket":"bucket-'), bucket, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit('{"k":'), text("l_partkey"), F.lit("}")))
        .when(kind == 4, '{"Records":"none"}')
        .when(kind == 5, "null")
        .when(kind == 6, "[1,2]")
        .otherwise(F.concat(F.lit('{"Records":['), F.array_join(records, ","), F.lit("]}"))))
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey")).alias("MessageId"),
        body.alias("Body"),
        F.lit(None).cast("map<string,struct<DataType:string,StringValue:string>>").alias("MessageAttributes"))


def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        numbered("shard-", F.col("user_id") % 4).alias("shard_id"), text("user_id").alias("PartitionKey"),
        text("event_id").alias("SequenceNumber"), F.col("ts").alias("ApproximateArrivalTimestamp"),
        F.encode("props", "UTF-8").alias("Data"), F.lit("NONE").alias("EncryptionType"))


def change_records(spark: SparkSession, sf: str) -> DataFrame:
    keys = F.concat(
        F.lit('{"o_orderkey":{"N":"'), text("o_orderkey"), F.lit('"},"o_custkey":{"N":"'), text("o_custkey"),
        F.lit('"}}'))
    image = F.concat(F.lit('{"o_orderpriority":{"S":"'), F.col("o_orderpriority"), F.lit('"}}'))
    operation = (
        F.when(F.col("o_orderstatus") == "O", "INSERT").when(F.col("o_orderstatus") == "P", "MODIFY")
        .otherwise("REMOVE"))
    return table(spark, sf, "orders").select(
        numbered("shard-", F.col("o_custkey") % 4).alias("shard_id"), F.lit("us-east-1").alias("AwsRegion"),
        F.struct(
            F.col("o_orderdate").cast("timestamp").alias("ApproximateCreationDateTime"),
            F.parse_json(keys).alias("Keys"),
            F.when(F.col("o_orderstatus") != "F", F.parse_json(image)).alias("NewImage"),
            F.lit(None).cast("variant").alias("OldImage"),
            text("o_orderkey").alias("SequenceNumber"), F.lit(64).cast("bigint").alias("SizeBytes"),
            F.lit("NEW_IMAGE").alias("StreamViewType")).alias("Dynamodb"),
        text("o_orderkey").alias("EventID"), operation.alias("EventName"),
        F.lit("aws:dynamodb").alias("EventSource"), F.lit("1.1").alias("EventVersion"),
        F.lit(None).cast("struct<PrincipalId:string,Type:string>").alias("UserIdentity"))


def event_points(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.lit("Shop").alias("namespace"), F.col("event_type").alias("metric"),
        F.create_map(F.lit("UserId"), text("user_id")).alias("dimensions"), F.lit("Count").alias("unit"),
        "ts", "value")


def price_points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.lit("Sales").alias("namespace"), F.lit("Price").alias("metric"),
        F.create_map(
            F.lit("ReturnFlag"), F.col("l_returnflag"),
            F.lit("LineStatus"), F.col("l_linestatus")).alias("dimensions"),
        F.lit("None").alias("unit"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_extendedprice").alias("value"))


def perf_series(spark: SparkSession, sf: str) -> DataFrame:
    """A series of two points per event; some points have no value."""
    first = F.struct("ts", F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"))
    second = F.struct(
        F.timestamp_micros(F.unix_micros("ts") + 1_000_000).alias("ts"),
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return events(spark, sf).select(
        numbered(f"arn:aws:rds:us-east-1:{ACCOUNT}:db:", F.col("user_id")).alias("instance_arn"),
        numbered("db.", F.col("event_type")).alias("metric"), F.date_trunc("hour", "ts").alias("poll_ts"),
        F.array(first, second).alias("points"))


def log_entries(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.unix_millis("ts")
    delay = F.when(F.col("event_id") % 7 == 0, 7_200_000).otherwise(0)
    return events(spark, sf).select(
        numbered("shop-", F.col("user_id") % 4).alias("log_group"), text("user_id").alias("log_stream"),
        stamp.alias("Timestamp"), (stamp + delay).alias("IngestionTime"), F.col("props").alias("Message"))


def branch_heads(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        numbered("repo-", F.col("user_id")).alias("repo"), F.lit("main").alias("branch"),
        F.col("ts").alias("poll_ts"), F.col("event_type").alias("commit_id"))


def pull_requests(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        numbered("repo-", F.col("user_id") % 4).alias("repo"), text("user_id").alias("pr_id"),
        F.col("ts").alias("poll_ts"), F.col("event_type").alias("status"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        numbered("pool-", F.col("user_id") % 3).alias("pool"), F.date_trunc("hour", "ts").alias("poll_ts"),
        text("user_id").alias("Username"), F.col("ts").alias("UserLastModifiedDate"),
        F.lit("CONFIRMED").alias("UserStatus"), F.lit(True).alias("Enabled"),
        F.array(F.struct(F.lit("kind").alias("Name"), F.col("event_type").alias("Value"))).alias("Attributes"))


def identities(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(numbered("us-east-1:", F.col("c_custkey")).alias("IdentityId"))


def datasets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        numbered("us-east-1:", F.col("o_custkey")).alias("IdentityId"),
        numbered("order-", F.col("o_orderkey")).alias("DatasetName"),
        F.col("o_orderdate").cast("timestamp").alias("CreationDate"),
        F.col("o_orderdate").cast("timestamp").alias("LastModifiedDate"),
        F.col("o_orderpriority").alias("LastModifiedBy"),
        F.col("o_totalprice").cast("bigint").alias("DataStorage"), F.lit(None).cast("bigint").alias("NumRecords"))


def sync_records(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            numbered("us-east-1:", F.col("o_custkey")).alias("IdentityId"),
            numbered("order-", F.col("o_orderkey")).alias("DatasetName"),
            F.concat_ws("/", text("l_linenumber"), text("l_partkey"), text("l_suppkey")).alias("Key"),
            F.col("l_quantity").cast("bigint").cast("string").alias("Value"),
            F.col("l_linenumber").cast("bigint").alias("SyncCount"), F.col("l_returnflag").alias("LastModifiedBy"),
            F.col("l_shipdate").cast("timestamp").alias("LastModifiedDate"),
            F.col("l_shipdate").cast("timestamp").alias("DeviceLastModifiedDate")))


def db_instances(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        numbered(f"arn:aws:rds:us-east-1:{ACCOUNT}:db:", F.col("s_suppkey") % 50).alias("arn"),
        numbered("db-", F.col("s_suppkey")).alias("resource_id"), F.col("s_suppkey").alias("pos"))


def subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    topic = numbered(f"{TOPIC_ARN}-", F.col("c_nationkey"))
    return table(spark, sf, "customer").select(
        topic.alias("topic_arn"), numbered("https://hooks.example/", F.col("c_mktsegment")).alias("endpoint"),
        F.concat(topic, F.lit(":"), text("c_custkey")).alias("subscription_arn"), F.col("c_custkey").alias("pos"))


def registered_sources(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lit("shop").alias("ns"), F.lower("n_name").alias("name"),
        F.concat(F.lit(f"{TOPIC_ARN}-"), F.lower("r_name"), F.lit("-"), text("n_nationkey")).alias("source"),
        F.col("n_nationkey").alias("pos"))


def http_requests(spark: SparkSession, sf: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type").isin("purchase", "click", "view"), "Notification")
        .when(F.col("event_type") == "signup", "SubscriptionConfirmation")
        .otherwise("Unknown"))
    prefix = F.when(F.col("event_id") % 2 == 0, "X-Amz-Sns-").otherwise("x-amz-sns-")
    notification = F.concat(
        F.lit('{"Type":"Notification","MessageId":"'), text("event_id"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit('","Subject":"user '), text("user_id"))),
        F.lit('","Message":"'), text("value"), F.lit('"}'))
    confirmation = F.concat(F.lit('{"Type":"SubscriptionConfirmation","Token":"t-'), text("event_id"), F.lit('"}'))
    body = (
        F.when(F.col("event_id") % 11 == 0, "not json")
        .when(F.col("event_type") == "signup", confirmation).otherwise(notification))
    return events(spark, sf).select(
        F.col("ts").alias("received"),
        F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
        numbered("/shop/nation_", F.col("user_id") % 30).alias("path"),
        F.create_map(
            F.concat(prefix, F.lit("Message-Type")), kind,
            F.concat(prefix, F.lit("Message-Id")), text("event_id"),
            F.concat(prefix, F.lit("Topic-Arn")), F.lit(TOPIC_ARN)).alias("headers"),
        body.alias("body"))


REASONS = [
    "CrashLoopBackOff", "ErrImagePull", "CreateContainerConfigError", "RevisionFailed", "RevisionFailed",
    "ContainerCreating", "CreateContainerError", "Unknown",
]


def status_messages(spark: SparkSession, sf: str) -> DataFrame:
    """A status per part, a minute apart."""
    pick = F.col("p_size") % 8
    message = (
        F.when(pick == 3, F.concat(F.lit("Container failed with: "), F.col("p_name")))
        .when((pick == 4) & (F.col("p_partkey") % 2 == 0), F.concat(F.lit('Unable to fetch image "'), F.col("p_name")))
        .when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('secret "'), F.col("p_name"), F.lit('" not found')))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('failed: configMap "'), F.col("p_name"), F.lit('" not found.')))
        .otherwise(F.col("p_name")))
    return table(spark, sf, "part").select(
        F.timestamp_seconds(1_704_067_200 + F.col("p_partkey") * 60).alias("ts"),
        F.get(F.array(*map(F.lit, REASONS)), pick).alias("reason"), message.alias("message"))


CONFIG_KINDS = [
    "sqs", "kinesis", "dynamodb", "s3", "cognitouserpool", "cognitoidentity", "codecommit", "cloudwatchlogs",
    "sns", "performanceinsights", "cloudwatch",
]
CONFIG_RESOURCES = [
    "sqs:us-east-1:123456789012:queue", "kinesis:us-east-1:123456789012:stream/clicks",
    "dynamodb:us-east-1:123456789012:table/orders", "s3:us-east-1:123456789012:bucket-name",
    "cognito-idp:us-east-1:123456789012:userpool/pool", "cognito-identity:us-east-1:123456789012:identitypool/pool",
    "codecommit:us-east-1:123456789012:repo",
    "logs:us-east-1:123456789012:log-group:/app/x:log-stream:s1", "sns:us-east-1:123456789012:topic",
    "rds:us-east-1:123456789012:db:shop", "",
]
CONFIG_INTERVALS = ["5m", "1h30m", "5", "42kg", "", "-1s", "1.5h", "250ms"]
CONFIG_TIMEOUTS = ["30s", "13h", "1m1.5s", "bad"]


def source_configs(spark: SparkSession, sf: str) -> DataFrame:
    """A configuration per customer; kind, and what is wrong with it, follow the customer number."""
    k = F.col("c_custkey")

    def pick(values: list[str]) -> Column:
        return F.get(F.array(*map(F.lit, values)), (k % len(values)).cast("int"))

    kind = pick(CONFIG_KINDS)
    arn = (
        F.when(kind == "cloudwatch", F.lit(None))
        .when(k % 7 == 5, F.concat(F.lit("not-arn:"), pick(CONFIG_RESOURCES)))
        .when(k % 7 == 6, "arn:aws:sqs")
        .otherwise(F.concat(F.lit("arn:aws:"), pick(CONFIG_RESOURCES), F.when(k % 5 == 4, "/extra").otherwise(""))))
    types = (
        F.when((kind == "s3") & (k % 4 == 0), "s3:ObjectRemoved:*,s3:ObjectCreated:Put,s3:ObjectCreated:Post")
        .when(kind == "s3", "s3:Replication:*,s3:Unknown")
        .when((kind == "codecommit") & (k % 3 == 0), "push,pull_request")
        .when(kind == "codecommit", "pull_request,push")
        .otherwise(""))
    return table(spark, sf, "customer").select(
        kind.alias("kind"), F.lower("c_mktsegment").alias("ns"), F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("name"),
        arn.alias("arn"),
        F.when(kind == "cloudwatch", F.when(k % 2 == 0, "us-east-1").otherwise("nowhere")).alias("region"),
        types.alias("event_types"),
        F.when(k % 9 != 0, pick(CONFIG_INTERVALS)).alias("polling_interval"),
        F.when(kind == "sqs", pick(CONFIG_TIMEOUTS)).alias("visibility_timeout"))


def poll_log(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        numbered("src-", F.col("user_id")).alias("source"), F.col("ts").alias("tick"),
        F.when(F.col("event_type") == "purchase", 3).otherwise(0).cast("bigint").alias("n_rows"),
        (F.col("event_type") == "error").alias("failed"))


def acks(spark: SparkSession, sf: str) -> DataFrame:
    """Acknowledgements; every tenth message is one that was delivered before."""
    message = F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 5).otherwise(0)
    return events(spark, sf).select(
        numbered("q-", message % 5).alias("queue"), "ts", message.cast("string").alias("MessageId"),
        numbered("r-", F.col("event_id")).alias("ReceiptHandle"))


def queue_log(spark: SparkSession, sf: str) -> DataFrame:
    measure = (
        F.when(F.col("event_type") == "click", "message_enqueued_process_count")
        .when(F.col("event_type") == "view", "message_dequeued_process_count")
        .when(F.col("event_type") == "purchase", "message_enqueued_delete_count")
        .when(F.col("event_type") == "signup", "message_dequeued_delete_count")
        .when(F.col("event_id") % 2 == 0, "queue_capacity_process")
        .otherwise("queue_capacity_delete"))
    return events(spark, sf).select(
        F.lit("sqssources").alias("resource_group"), numbered("ns-", F.col("user_id") % 3).alias("namespace"),
        numbered("q-", F.col("user_id") % 5).alias("name"), "ts", measure.alias("measure"),
        F.floor("value").cast("bigint").alias("value"))


def metric_query_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON list of queries per nation: a statistic, an expression, one of both, and one of neither."""
    k, name = text("n_nationkey"), F.lower("n_name")
    metric = F.concat(
        F.lit('{"metric":{"dimensions":[{"name":"UserId","value":"'), k,
        F.lit('"}],"metricName":"click","namespace":"Shop"},"period":60,"stat":"Sum"}'))
    listed = F.concat(
        F.lit('[{"name":"a_'), name, F.lit('","metric":'), metric,
        F.lit('},{"name":"b_'), name, F.lit('","expression":"a * '), k,
        F.lit('"},{"name":"c_'), name, F.lit('","expression":"a + 1","metric":'), metric,
        F.lit('},{"name":"d_'), name, F.lit('"}]'))
    return table(spark, sf, "nation").select("n_nationkey", listed.alias("queries"))


def bucket_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Notification settings per bucket and id, as the service lists them (events sorted)."""
    listed = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("s3:ObjectRemoved:*"))).otherwise(
        F.array(F.lit("s3:ObjectCreated:Post"), F.lit("s3:ObjectCreated:Put")))
    return table(spark, sf, "orders").select(
        numbered("b-", F.col("o_custkey")).alias("bucket"), numbered("cfg-", F.col("o_orderkey")).alias("id"),
        listed.alias("events"), F.lit(QUEUE_ARN).alias("queue_arn"))


def bucket_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted settings: a known id for urgent orders, a new id for the rest."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf, "orders").select(
        numbered("b-", F.col("o_custkey")).alias("bucket"),
        F.concat(F.when(urgent, "cfg-").otherwise("new-"), text("o_orderkey")).alias("id"),
        F.array(F.lit("s3:ObjectCreated:Put"), F.lit("s3:ObjectCreated:Post")).alias("events"),
        F.lit(QUEUE_ARN).alias("queue_arn"))


def desired_workloads(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        numbered("w-", k).alias("name"), F.when(k % 6 == 0, "").otherwise(F.col("p_brand")).alias("image"),
        F.when(k % 5 == 0, 0).otherwise(F.col("p_size")).cast("bigint").alias("replicas"),
        F.when(k % 4 != 0, F.create_map(F.lit("type"), F.col("p_type"))).alias("labels"),
        F.split("p_name", " ").alias("args"))


def current_workloads(spark: SparkSession, sf: str) -> DataFrame:
    """What runs: some workloads differ, and those of one brand are missing."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").where("p_brand <> 'Brand#1'").select(
        numbered("w-", k).alias("name"), F.when(k % 9 == 0, "old").otherwise(F.col("p_brand")).alias("image"),
        (F.col("p_size") + F.when(k % 10 == 0, 1).otherwise(0)).cast("bigint").alias("replicas"),
        F.create_map(
            F.lit("type"), F.when(k % 7 == 0, "other").otherwise(F.col("p_type")), F.lit("zone"), F.lit("a")).alias("labels"),
        F.when(k % 11 == 0, F.array(F.lit("x"))).otherwise(F.split(F.concat("p_name", F.lit(" tail")), " ")).alias("args"))
