"""Classification of failure reasons reported by running workloads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: reasons of containers that fail to run
RUNTIME_REASONS = [
    "CrashLoopBackOff",
    "RunContainerError",
    "RunInitContainerError",
    "CreatePodSandboxError",
    "ConfigPodSandboxError",
    "VerifyNonRootError",
]
# fixed values: reasons of images that cannot be pulled
IMAGE_REASONS = [
    "ImagePullBackOff",
    "ImageInspectError",
    "ErrImagePull",
    "ErrImageNeverPull",
    "RegistryUnavailable",
    "InvalidImageName",
]
# fixed values: reasons that may stand for a missing resource
REVISION_FAILED = "RevisionFailed"
MISSING_REASONS = ["CreateContainerConfigError", "CreateContainerError", REVISION_FAILED]
CONTAINER_FAILED = "Container failed with: "
IMAGE_FAILED = 'Unable to fetch image "'

# a resource name is at most 251 characters between its quotes
_NOT_FOUND = r'([A-Za-z]+) "[^"]{0,251}" not found\.?\z'


def failure_reason(reason: Column, message: Column) -> Column:
    """The most specific reason that can be told; the given one otherwise."""
    revision = reason == REVISION_FAILED
    missing = F.regexp_extract(message, _NOT_FOUND, 1)
    titled = F.concat(F.upper(F.substring(missing, 1, 1)), F.call_function("substring", missing, F.lit(2)))
    return (
        F.when(reason.isin(RUNTIME_REASONS) | (revision & message.contains(CONTAINER_FAILED)),
               "AppRuntimeFailure")
        .when(reason.isin(IMAGE_REASONS) | (revision & message.contains(IMAGE_FAILED)),
              "BadContainerImage")
        .when(reason.isin(MISSING_REASONS) & (missing != ""), F.concat(F.lit("Missing"), titled))
        .otherwise(reason))
