"""Session settings for an S3-compatible object store."""

from __future__ import annotations


def s3a_settings(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    path_style: bool = True,
    tls: bool = False,
    committer: str | None = "directory",
) -> dict[str, str]:
    """Settings to pass to the session builder. The caller owns the secrets."""
    if not access_key or not secret_key:
        raise ValueError("object store credentials are missing")
    # Names of the Hadoop settings.
    prefix = "spark.hadoop.fs.s3a"
    settings = {
        f"{prefix}.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.path.style.access": str(path_style).lower(),
        f"{prefix}.connection.ssl.enabled": str(tls).lower(),
        f"{prefix}.access.key": access_key,
        f"{prefix}.secret.key": secret_key,
    }
    if committer:
        settings[f"{prefix}.committer.name"] = committer
    return settings
