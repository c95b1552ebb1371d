"""Checks and defaults for source configuration values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .duration import HOUR, MINUTE, SECOND

# fixed values: service and resource pattern of the ARNs each kind accepts
ARN_RULES = {
    "sqs": ("sqs", ".+"),
    "kinesis": ("kinesis", "stream/.+"),
    "dynamodb": ("dynamodb", "table/.+"),
    "s3": ("s3", "[0-9a-z][0-9a-z.-]{2,62}"),
    "cognitouserpool": ("cognito-idp", "userpool/.+"),
    "cognitoidentity": ("cognito-identity", "identitypool/.+"),
    "codecommit": ("codecommit", ".+"),
    "cloudwatchlogs": ("logs", ".+"),
    "sns": ("sns", ".+"),
    "performanceinsights": ("rds", ".+"),
}
REGION = r"[a-z]{2}(-gov)?-[a-z]+-[0-9]"
QUERY_NAME = r"^[a-z][0-9A-Za-z_]{0,254}\z"

# fixed values: bucket notifications a source may subscribe to
OBJECT_EVENTS = [
    "s3:ObjectCreated:*",
    "s3:ObjectCreated:Put",
    "s3:ObjectCreated:Post",
    "s3:ObjectCreated:Copy",
    "s3:ObjectCreated:CompleteMultipartUpload",
    "s3:ObjectRemoved:*",
    "s3:ObjectRemoved:Delete",
    "s3:ObjectRemoved:DeleteMarkerCreated",
    "s3:ObjectRestore:*",
    "s3:ObjectRestore:Post",
    "s3:ObjectRestore:Completed",
    "s3:ReducedRedundancyLostObject",
    "s3:Replication:*",
    "s3:Replication:OperationFailedReplication",
    "s3:Replication:OperationNotTracked",
    "s3:Replication:OperationMissedThreshold",
    "s3:Replication:OperationReplicatedAfterThreshold",
]
REPO_EVENTS = ["push", "pull_request"]

DEFAULT_INTERVAL = 5 * MINUTE
MAX_VISIBILITY = 12 * HOUR


def arn_pattern(kind: str) -> str:
    service, resource = ARN_RULES[kind]
    return rf"^arn:aws(-cn|-us-gov)?:{service}:{REGION}:[0-9]{{12}}:{resource}\z"


def valid_source_arn(kind: Column, arn: Column) -> Column:
    """Whether the ARN has the form its kind asks for; null for kinds without one."""
    checked = None
    for name in ARN_RULES:
        test = F.coalesce(arn.rlike(arn_pattern(name)), F.lit(False))
        checked = F.when(kind == name, test) if checked is None else checked.when(kind == name, test)
    return checked


def valid_region(region: Column) -> Column:
    return region.rlike(rf"^{REGION}\z")


def valid_query_name(name: Column) -> Column:
    return name.rlike(QUERY_NAME)


def valid_visibility_timeout(nanos: Column) -> Column:
    """Whole seconds, or null when out of bounds."""
    return F.when(nanos.between(0, MAX_VISIBILITY), F.floor(nanos / SECOND).cast("bigint"))


def polling_interval(nanos: Column) -> Column:
    return F.when(nanos > 0, nanos).otherwise(F.lit(DEFAULT_INTERVAL).cast("bigint"))
