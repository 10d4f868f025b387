"""Session settings for an S3-compatible object store."""

from __future__ import annotations


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    bucket: str | None = None,
) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings, for all buckets or for one, to pass to the session.

    Keys come from the caller; leave them out to use the cluster's own credentials provider.
    """
    prefix = "spark.hadoop.fs.s3a." + (f"bucket.{bucket}." if bucket else "")
    if (access_key is None) != (secret_key is None):
        raise ValueError("give both keys or neither")
    conf = {prefix + "endpoint": endpoint, prefix + "path.style.access": str(path_style).lower()}
    if access_key is not None:
        conf[prefix + "access.key"] = access_key
        conf[prefix + "secret.key"] = secret_key
    return conf
