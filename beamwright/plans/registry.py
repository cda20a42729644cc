"""Named ingestors: functions from a files DataFrame to records and issues."""

from collections.abc import Callable

from pyspark.sql import DataFrame

Ingestor = Callable[..., tuple[DataFrame, DataFrame]]
_INGESTORS: dict[str, Ingestor] = {}


def register_ingestor(name: str, fn: Ingestor) -> None:
    _INGESTORS[name] = fn


def run_ingestor(name: str, *inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of the ingestor registered under ``name``."""
    if name not in _INGESTORS:
        raise KeyError(f"no ingestor named {name!r}; known: {sorted(_INGESTORS)}")
    return _INGESTORS[name](*inputs)


def scan_ingestor(meta: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The built-in ingestor for scan files.

    The metadata is read once: files with what it says about them are written, and records and issues come from that table.
    """
    from beamwright import fixed
    from beamwright.operators import catalogue
    from beamwright.session import materialise

    keys = [*fixed.CATALOGUE_KEYS, *fixed.SCIENTIFIC_KEYS]
    wide = materialise(catalogue.described(meta, files, keys), "described")
    records = catalogue.records_of(wide)
    return records, catalogue.absent_fields(wide, keys).unionByName(catalogue.name_issues(records))


register_ingestor("scan", scan_ingestor)
