"""Sources described by a configuration dict (usually read from JSON)."""

from __future__ import annotations

import difflib

from pyspark.sql import DataFrame, SparkSession

from meterlake.paths import refuse_overlap
from meterlake.schema import text_schema

# The file options Spark documents, by format.
_ANY_FILE = (
    "basePath",
    "pathGlobFilter",
    "recursiveFileLookup",
    "modifiedBefore",
    "modifiedAfter",
    "ignoreCorruptFiles",
    "ignoreMissingFiles",
    "maxRecordsPerFile",
    "partitionOverwriteMode",
    "timeZone",
)
_CSV = (
    "sep",
    "delimiter",
    "encoding",
    "charset",
    "quote",
    "quoteAll",
    "escape",
    "escapeQuotes",
    "comment",
    "header",
    "inferSchema",
    "preferDate",
    "enforceSchema",
    "ignoreLeadingWhiteSpace",
    "ignoreTrailingWhiteSpace",
    "nullValue",
    "nanValue",
    "positiveInf",
    "negativeInf",
    "dateFormat",
    "timestampFormat",
    "timestampNTZFormat",
    "enableDateTimeParsingFallback",
    "maxColumns",
    "maxCharsPerColumn",
    "mode",
    "columnNameOfCorruptRecord",
    "multiLine",
    "charToEscapeQuoteEscaping",
    "samplingRatio",
    "emptyValue",
    "locale",
    "lineSep",
    "unescapedQuoteHandling",
    "compression",
    "codec",
    "extension",
)
_PARQUET = ("mergeSchema", "datetimeRebaseMode", "int96RebaseMode", "compression")
KNOWN_OPTIONS = {"csv": _CSV + _ANY_FILE, "parquet": _PARQUET + _ANY_FILE}
#: How alike an unknown name and a known one are for the first to be a slip.
MISSPELT = 0.85


def check_options(fmt: str, options: dict[str, str]) -> None:
    """Reject a misspelt option, which Spark would silently ignore.

    Names that resemble no known one pass: sources have options of their own.
    """
    lowered = {name.lower(): name for name in KNOWN_OPTIONS.get(fmt.lower(), ())}
    for option in options:
        if option.lower() not in lowered:
            near = difflib.get_close_matches(option.lower(), lowered, n=1, cutoff=MISSPELT)
            if near:
                raise ValueError(
                    f"unknown {fmt} option {option!r}; did you mean {lowered[near[0]]!r}?"
                )


def check_config(config: dict) -> None:
    source = config["source"]
    check_options(source["format"], source.get("options", {}))
    destination = config.get("destination")
    if destination:
        refuse_overlap(source["path"], destination["path"])


def read_data(spark: SparkSession, config: dict) -> DataFrame:
    """Read ``config["source"]``.

    ``config["schema"]`` names the columns, all read as text; parsing is a later
    step. Without it the reader's own rules apply: text columns for CSV unless
    the options ask for inference.
    """
    check_config(config)
    source = config["source"]
    options = dict(source.get("options", {}))
    reader = spark.read.format(source["format"])
    if "schema" in config:
        reader = reader.schema(text_schema(config["schema"]))
        if source["format"].lower() == "csv":
            # compare the header with the schema instead of mapping by position
            options.setdefault("enforceSchema", "false")
    return reader.options(**options).load(source["path"])
