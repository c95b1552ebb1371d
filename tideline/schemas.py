"""Event envelope, payload types per kind, and the layout of landed tables."""

from __future__ import annotations

from pyspark.sql import types as T

STR = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
BIN = T.BinaryType()
TS = T.TimestampType()
VARIANT = T.VariantType()
STR_MAP = T.MapType(STR, STR)


def struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def array(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


EVENT = struct({
    "id": STR, "source": STR, "specversion": STR, "type": STR, "subject": STR, "time": TS,
    "datacontenttype": STR, "extensions": STR_MAP, "data": STR,
})

MESSAGE_ATTRIBUTE = struct({
    "BinaryListValues": array(STR), "BinaryValue": STR, "DataType": STR,
    "StringListValues": array(STR), "StringValue": STR,
})
QUEUE_MESSAGE = struct({
    "Attributes": STR_MAP, "Body": STR, "MD5OfBody": STR, "MD5OfMessageAttributes": STR,
    "MessageAttributes": T.MapType(STR, MESSAGE_ATTRIBUTE), "MessageId": STR, "ReceiptHandle": STR,
})
OBJECT_EVENT = struct({
    "eventVersion": STR, "eventSource": STR, "awsRegion": STR, "eventTime": TS, "eventName": STR,
    "userIdentity": struct({"principalId": STR}),
    "requestParameters": struct({"sourceIPAddress": STR}),
    "responseElements": struct({"x-amz-request-id": STR, "x-amz-id-2": STR}),
    "s3": struct({
        "s3SchemaVersion": STR, "configurationId": STR,
        "bucket": struct({"name": STR, "ownerIdentity": struct({"principalId": STR}), "arn": STR}),
        "object": struct({"key": STR, "size": LONG, "eTag": STR, "versionId": STR, "sequencer": STR}),
    }),
    "glacierEventData": struct({"restoreEventData": struct({
        "lifecycleRestorationExpiryTime": TS, "lifecycleRestoreStorageClass": STR})}),
})
STREAM_RECORD = struct({
    "ApproximateArrivalTimestamp": TS, "Data": BIN, "EncryptionType": STR,
    "PartitionKey": STR, "SequenceNumber": STR,
})
# attribute values are recursive, which a struct type cannot express
CHANGE_RECORD = struct({
    "AwsRegion": STR,
    "Dynamodb": struct({
        "ApproximateCreationDateTime": TS, "Keys": VARIANT, "NewImage": VARIANT, "OldImage": VARIANT,
        "SequenceNumber": STR, "SizeBytes": LONG, "StreamViewType": STR}),
    "EventID": STR, "EventName": STR, "EventSource": STR, "EventVersion": STR,
    "UserIdentity": struct({"PrincipalId": STR, "Type": STR}),
})
LOG_EVENT = struct({"IngestionTime": LONG, "Message": STR, "Timestamp": LONG})
METRIC_MESSAGE = struct({"Code": STR, "Value": STR})
METRIC_RESULT = struct({
    "Id": STR, "Label": STR, "Messages": array(METRIC_MESSAGE), "StatusCode": STR,
    "Timestamps": array(TS), "Values": array(DOUBLE),
})
PERF_METRIC = struct({"metric": STR, "value": DOUBLE})
GIT_USER = struct({"Date": STR, "Email": STR, "Name": STR})
COMMIT = struct({
    "AdditionalData": STR, "Author": GIT_USER, "CommitId": STR, "Committer": GIT_USER,
    "Message": STR, "Parents": array(STR), "TreeId": STR,
})
PULL_REQUEST = struct({
    "ApprovalRules": array(struct({
        "ApprovalRuleContent": STR, "ApprovalRuleId": STR, "ApprovalRuleName": STR,
        "CreationDate": TS, "LastModifiedDate": TS, "LastModifiedUser": STR,
        "OriginApprovalRuleTemplate": struct({
            "ApprovalRuleTemplateId": STR, "ApprovalRuleTemplateName": STR}),
        "RuleContentSha256": STR})),
    "AuthorArn": STR, "ClientRequestToken": STR, "CreationDate": TS, "Description": STR,
    "LastActivityDate": TS, "PullRequestId": STR, "PullRequestStatus": STR,
    "PullRequestTargets": array(struct({
        "DestinationCommit": STR, "DestinationReference": STR, "MergeBase": STR,
        "MergeMetadata": struct({
            "IsMerged": BOOL, "MergeCommitId": STR, "MergeOption": STR, "MergedBy": STR}),
        "RepositoryName": STR, "SourceCommit": STR, "SourceReference": STR})),
    "RevisionId": STR, "Title": STR,
})
SYNC_RECORD = struct({
    "DeviceLastModifiedDate": TS, "Key": STR, "LastModifiedBy": STR, "LastModifiedDate": TS,
    "SyncCount": LONG, "Value": STR,
})
SYNC_DATASET = struct({
    "CreationDate": TS, "DataStorage": LONG, "DatasetName": STR, "IdentityID": STR,
    "LastModifiedBy": STR, "LastModifiedDate": TS, "NumRecords": LONG, "EventType": STR,
    "Region": STR, "IdentityPoolID": STR, "DatasetRecords": array(SYNC_RECORD),
})
USER = struct({
    "Attributes": array(struct({"Name": STR, "Value": STR})), "Enabled": BOOL,
    "MFAOptions": array(struct({"AttributeName": STR, "DeliveryMedium": STR})),
    "UserCreateDate": TS, "UserLastModifiedDate": TS, "UserStatus": STR, "Username": STR,
})
NOTIFICATION = struct({
    "Type": STR, "MessageId": STR, "TopicArn": STR, "Subject": STR, "Message": STR, "Timestamp": TS,
    "SignatureVersion": STR, "Signature": STR, "SigningCertURL": STR, "UnsubscribeURL": STR,
    "MessageAttributes": T.MapType(STR, struct({"Type": STR, "Value": STR})),
})

# what an event's ``data`` holds, per kind
PAYLOADS: dict[str, T.StructType] = {
    "queue_message": QUEUE_MESSAGE,
    "object_event": OBJECT_EVENT,
    "stream_record": STREAM_RECORD,
    "change_record": CHANGE_RECORD,
    "log_event": LOG_EVENT,
    "metric_result": METRIC_RESULT,
    "metric_message": METRIC_MESSAGE,
    "commit": COMMIT,
    "pull_request": PULL_REQUEST,
    "sync_dataset": SYNC_DATASET,
    "user": USER,
    "notification": NOTIFICATION,
    "perf_metric": PERF_METRIC,
}

# fields a payload may leave out; every other field is required
OPTIONAL = {
    "object_event": {"glacierEventData", "s3.object.versionId"},
    "notification": {"Subject", "MessageAttributes"},
}
# fields that may be JSON null
NULLABLE = {
    "queue_message": {
        "MD5OfMessageAttributes", "MessageAttributes", "MessageAttributes.BinaryListValues",
        "MessageAttributes.BinaryValue", "MessageAttributes.StringListValues",
        "MessageAttributes.StringValue"},
}
ENUMS = {
    "notification": {
        "Type": ["Notification"],
        "MessageAttributes.Type": ["String", "String.Array", "Number", "Binary"]},
}
# nested objects that accept fields beyond the declared ones
OPEN = {"notification": {"MessageAttributes"}}


def _landed(extra: dict[str, T.DataType], payload: T.StructType) -> T.StructType:
    return T.StructType(struct(extra).fields + payload.fields)


# columns of a landed table: the payload plus where and when it was read
LANDED: dict[str, T.StructType] = {
    "queue_message": _landed({"SentTimestamp": TS}, QUEUE_MESSAGE),
    "object_event": _landed({"SentTimestamp": TS}, QUEUE_MESSAGE),
    "stream_record": _landed({"shard_id": STR}, STREAM_RECORD),
    "change_record": _landed({"shard_id": STR}, CHANGE_RECORD),
    "log_event": _landed({"log_group": STR, "log_stream": STR}, LOG_EVENT),
    "metric_point": struct({
        "namespace": STR, "metric": STR, "dimensions": STR_MAP, "unit": STR, "ts": TS,
        "value": DOUBLE}),
    "perf_metric": struct({
        "instance_arn": STR, "metric": STR, "poll_ts": TS,
        "points": array(struct({"ts": TS, "value": DOUBLE}))}),
    "repo_snapshot": struct({"repo": STR, "branch": STR, "poll_ts": TS, "commit_id": STR}),
    "pr_snapshot": struct({"repo": STR, "pr_id": STR, "poll_ts": TS, "status": STR}),
    "identity": struct({"IdentityId": STR}),
    "dataset": struct({
        "CreationDate": TS, "DataStorage": LONG, "DatasetName": STR, "IdentityId": STR,
        "LastModifiedBy": STR, "LastModifiedDate": TS, "NumRecords": LONG}),
    "sync_record": _landed({"IdentityId": STR, "DatasetName": STR}, SYNC_RECORD),
    "user": _landed({"pool": STR, "poll_ts": TS}, USER),
    "notification": struct({
        "received": TS, "method": STR, "path": STR, "headers": STR_MAP, "body": STR}),
}

# the column a start position applies to
ARRIVAL = {
    "queue_message": "SentTimestamp",
    "object_event": "SentTimestamp",
    "stream_record": "ApproximateArrivalTimestamp",
    "change_record": "Dynamodb.ApproximateCreationDateTime",
    "log_event": "Timestamp",
    "metric_point": "ts",
    "perf_metric": "poll_ts",
    "repo_snapshot": "poll_ts",
    "pr_snapshot": "poll_ts",
    "dataset": "LastModifiedDate",
    "sync_record": "LastModifiedDate",
    "user": "poll_ts",
    "notification": "received",
}
