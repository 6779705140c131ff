"""Zone paths and the fixed names that datasets on disk must carry."""

from __future__ import annotations

# Names, formats and texts that stored data and control tables rely on.
RAW_ZONE = "raw"
TRUSTED_ZONE = "trusted"
FAILED_ZONE = "failed"
ARCHIVE_ZONE = "raw_processados"
PARTITION_MONTH = "PARTITION_DT"
KEY_BUCKET = "KEY_BUCKET"
INSERTED_COLUMN = "InsertedDate"
UPDATED_COLUMN = "UpdatedDate"
WINDOW_DAYS = 35
MONTH_FORMAT = "yyyy-MM"
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLISECOND_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
RUN_ZONE = "America/Sao_Paulo"
PURGE_GREW_MESSAGE = "Tamanho final maoir que o inicial."


def table_path(root: str, zone: str, highway: str, system: str, schema: str, table: str) -> str:
    """Directory of one table in one zone."""
    return "/".join([root.rstrip("/"), zone, highway, system, schema, table])


def unit_path(path: str, unit: str, template: bool = False) -> str:
    """Path of one business unit: a sub-directory, or ``%bu%`` replaced in a template."""
    return path.replace("%bu%", unit) if template else f"{path.rstrip('/')}/{unit}/"


def split_keys(primary_key: str) -> list[str]:
    """Key columns of a control row, written with slashes between them."""
    keys = [k.strip() for k in primary_key.split("/") if k.strip()]
    if not keys:
        raise ValueError("the control row names no key column")
    return keys
