"""Secrets in texts, and weak candidates that only count together. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, stage

#: Code points between two parts that still belong to one credential.
SCOPE = 200
MASK = "[SECRET]"

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: Names of weak parts start a word; ``\b`` would depend on the Java version.
_WORD = r"(?<![A-Za-z0-9_])"


@dataclass(frozen=True)
class Part:
    """A pattern; ``wanted`` is a cheap test that every match passes."""

    kind: str
    pattern: str
    wanted: str
    value_group: int = 0


_ASSIGNED = "(contains(text, ':') OR contains(text, '='))"

PARTS = (
    Part(
        "assign",
        rf"(?i:password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)",
        _ASSIGNED,
        value_group=1,
    ),
    Part("access", r"AKIA[A-Z0-9]{12,}", "contains(text, 'AKIA')"),
    Part("hex", r"[0-9a-f]{32,}", "text RLIKE '[0-9a-f]{32}'"),
    Part(
        "identifier",
        rf"{_WORD}(?i:user_?name|user_?id|user|login|client_id|account_?id)"
        rf"{_VALUE}[A-Za-z0-9_.@-]{{3,}}",
        _ASSIGNED,
    ),
    Part(
        "secret",
        rf"{_WORD}(?i:pwd|pass|passphrase|secret_key|private_key|auth)"
        rf"{_VALUE}[A-Za-z0-9+/_.=-]{{4,}}",
        _ASSIGNED,
    ),
    Part(
        "endpoint",
        rf"{_WORD}(?i:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://"
        r"[A-Za-z0-9._~:/?#@%&=+-]+"
        rf"|{_WORD}(?i:host|server|endpoint){_VALUE}[A-Za-z0-9.-]{{3,}}",
        _ASSIGNED,
    ),
)
KINDS = [part.kind for part in PARTS]
BASE = KINDS[:3]
#: What a kind can be for a credential.
ROLES = {
    "access": "identifier",
    "identifier": "identifier",
    "assign": "secret",
    "hex": "secret",
    "secret": "secret",
    "endpoint": "endpoint",
}
#: A weak kind counts where one of these roles stands within its scope.
COMPLEMENTS = {
    "identifier": ["secret"],
    "secret": ["identifier", "endpoint"],
    "endpoint": ["secret"],
}
#: An assigned value is a secret from this length on, and a weak one from the second.
LONG_VALUE, SHORT_VALUE = 8, 4

KEY = ["doc_id", "sha"]
_SPANS = "array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"


def _lengths(part: Part) -> Column:
    """Per match, in order: length of the text since the match before, of match and value.

    ``\\G`` ties each match to the end of the one before, so a text is passed once.
    """
    anchored = F.lit(rf"(?s)\G(.*?)({part.pattern})")

    def every(group: int) -> Column:
        return F.regexp_extract_all("text", anchored, F.lit(group))

    value = every(2 + part.value_group) if part.value_group else every(2)
    found = F.transform(
        F.arrays_zip(every(1).alias("gap"), every(2).alias("match"), value.alias("value")),
        lambda m, i: F.struct(
            F.lit(part.kind).alias("kind"),
            i.alias("number"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["match"]).alias("size"),
            F.length(m["value"]).alias("value"),
        ),
    )
    return F.when(F.expr(part.wanted), found).otherwise(F.slice(found, 1, 0))


def _scan(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Stored: id of each document, and for those with any match a digest and the lengths."""
    rows = id_and_text(docs, id_column, text_column)
    wanted = F.expr(" OR ".join(dict.fromkeys(part.wanted for part in PARTS)))
    matches = F.when(wanted, F.concat(*[_lengths(part) for part in PARTS]))
    rows = rows.select("doc_id", "text", matches.alias("matches"))
    some = F.size("matches") > 0
    return stage(
        rows.select(
            "doc_id",
            F.when(some, F.sha2("text", 256)).alias("sha"),
            F.when(some, F.col("matches")).alias("matches"),
        ),
        "secret_matches",
    )


def _spans(scanned: DataFrame) -> DataFrame:
    """Every match with its place: the lengths before it, summed within the document."""
    rows = (
        scanned.filter("sha IS NOT NULL")
        .dropDuplicates(KEY)
        .select(*KEY, F.explode("matches").alias("match"))
        .select(*KEY, "match.*")
    )
    before = Window.partitionBy(*KEY, "kind").orderBy("number").rowsBetween(
        Window.unboundedPreceding, 0
    )
    assigned = F.col("kind") == "assign"
    return (
        rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("long"))
        .filter(~assigned | (F.col("value") >= SHORT_VALUE))
        .select(
            *KEY,
            F.when(assigned & (F.col("value") < LONG_VALUE), "secret")
            .otherwise(F.col("kind"))
            .alias("kind"),
            (F.col("end") - F.col("size")).alias("start"),
            "end",
        )
    )


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """Base spans, and weak ones with a complementary part within their scope.

    The interval join is one sweep forward and one back over the parts of a document:
    the farthest end and the nearest start of each role seen so far decide, so no pair
    of parts is ever made.
    """
    role = F.lit(None).cast("string")
    for kind, its_role in ROLES.items():
        role = F.when(F.col("kind") == kind, its_role).otherwise(role)
    order = ["start", "end", "kind"]
    ahead = Window.partitionBy(*KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    back = (
        Window.partitionBy(*KEY)
        .orderBy(*[F.col(c).desc() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = spans.withColumn("role", role)
    near = {}
    for name in dict.fromkeys(ROLES.values()):
        here = F.col("role") == name
        rows = rows.withColumns(
            {
                f"{name}_before": F.max(F.when(here, F.col("end"))).over(ahead),
                f"{name}_after": F.min(F.when(here, F.col("start"))).over(back),
            }
        )
        near[name] = F.coalesce(
            F.col("start") - F.col(f"{name}_before") <= scope, F.lit(False)
        ) | F.coalesce(F.col(f"{name}_after") - F.col("end") <= scope, F.lit(False))
    counts = F.col("kind").isin(BASE)
    for kind, roles in COMPLEMENTS.items():
        for name in roles:
            counts = counts | ((F.col("kind") == kind) & near[name])
    return rows.filter(counts).select(*KEY, "kind", "start", "end")


def _joined(spans: str, *kinds: str) -> Column:
    chosen = f"filter({spans}, s -> s.rank < {len(kinds)})" if kinds else spans
    return F.expr(
        f"array_join(transform({chosen}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    )


def _per_document(spans: DataFrame) -> DataFrame:
    rank = F.array_position(F.lit(KINDS), F.col("kind")) - 1
    return spans.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias(
            "found"
        )
    )


def find_secrets(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    scope: int = SCOPE,
) -> DataFrame:
    """One row per document with the places of its secrets.

    Strong kinds count alone: an assigned password, secret, token or key of 8 characters
    or more (``assign``), an access key (``access``), 32 or more lower-case hexadecimal
    digits (``hex``). Weak kinds, names of users, short or loosely named secrets and
    addresses of services, count only with a complementary part at most ``scope`` code
    points away in the same text: an identifier or an endpoint with a secret.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked. Places are
    code points, end exclusive, as kind:start:end. A null or empty text has none; rows
    that repeat id and text get the same result each; an empty table gives no rows.
    """
    scanned = _scan(docs, id_column, text_column)
    spans = _per_document(_linked(_spans(scanned), scope)).select(
        F.col("doc_id").alias("found_id"), F.col("sha").alias("found_sha"), "found"
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("sha") == F.col("found_sha"))
    found = F.coalesce("found", F.expr(f"cast(array() AS {_SPANS})"))
    rows = scanned.select("doc_id", "sha").join(spans, same, "left").withColumn("found", found)

    def count(kind: str) -> Column:
        return F.expr(f"size(filter(found, s -> s.kind = '{kind}'))").cast("long")

    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_joined("found", *BASE), 256).alias("base_sha256"),
        _joined("found").alias("spans"),
        F.expr(f"size(filter(found, s -> s.rank >= {len(BASE)}))").cast("long").alias("n_linked"),
    )


def redact(docs: DataFrame, *, scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; ``n_chars`` follows the new text.

    Overlapping and touching spans become one mask. Texts without secrets, null texts
    and all other columns stay as they are.
    """
    spans = _linked(_spans(_scan(docs, "doc_id", "text")), scope)
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1
    )
    upto = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, 0
    )
    begins = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    merged = (
        spans.withColumn("begins", begins)
        .withColumn("number", F.sum(F.col("begins").cast("int")).over(upto))
        .groupBy(*KEY, "number")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hidden"))
        .withColumnsRenamed({"doc_id": "found_id", "sha": "found_sha"})
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
    )
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("sha") == F.col("found_sha"))
    pieces = F.expr(
        """transform(sequence(0, size(hidden)), i -> substring(row.text,
             cast(if(i = 0, 0, get(hidden, i - 1).end) + 1 AS int),
             cast(coalesce(get(hidden, i).start, length(row.text))
                  - if(i = 0, 0, get(hidden, i - 1).end) AS int)))"""
    )
    text = F.when(F.col("hidden").isNull(), F.col("row.text")).otherwise(
        F.array_join(pieces, mask)
    )
    changed = rows.join(merged, same, "left").select(
        F.col("row").withField("text", text).alias("row"), F.col("hidden").isNull().alias("same")
    )
    if "n_chars" in docs.columns:
        length = F.when(F.col("same"), F.col("row.n_chars")).otherwise(F.length("row.text"))
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("row", F.col("row").withField("n_chars", length.cast(kind)))
    return changed.select("row.*")
