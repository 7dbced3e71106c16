"""Licence scan: canonical digests of whole texts, hash-joined to those of known licences.

A text is brought to a canonical form (lower case, no notices of holders, equivalent spellings made
one, punctuation and white space folded) and its SHA-256 is looked up among the digests of the
known licences in the same form. All of it is DataFrame functions. Besides the entire text, each
line that speaks of a licence is looked up by itself, for notices inside longer documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import KNOWN, STANDARD

#: Equivalent spellings, applied in this order to lower-case words separated by one space.
SPELLINGS = (
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("favour", "favor"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("non commercial", "noncommercial"),
    ("non infring", "noninfring"),
    ("per cent", "percent"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
)
#: Notices of holders, dropped in this order. By themselves, however the text is wrapped: that of
#: the Free Software Foundation and the blanks of its appendices.
_YEAR = "(?:1[89]|20)[0-9]{2}"
HOLDERS = (
    r"copyright\s+\(c\)\s+[0-9,\s-]+free\s+software\s+foundation,\s+inc\.(?:\s+51\s+franklin\s+st(?:reet)?,\s+fifth\s+floor,\s+boston,\s+ma\s+02110-1301,?\s+usa)?(?:\s+<https?://(?:www\.)?fsf\.org/>)?",
    r"copyright\s+\(c\)\s+(?:<year>|19[xy]{2}|year|_+)(?:\s+(?:<?name\s+of\s+author>?|your\s+name))?",
)
#: What names a holder in running text, and the openings of the licences that follow such notices.
MARK = r"[\s:]+(?:\(c\)|©|" + _YEAR + ")"
OPENING = r"permission\s+is\s+hereby\s+granted|permission\s+to\s+use,|redistribution\s+and\s+use\s+in|this\s+software\s+is\s+provided\s+'as-is'"
#: Lines that name a holder: a year or a sign, and not a word of the licences' own sentences.
HOLDER_LINE = rf"(^|\n)[ \t#*/;-]*(?:(?:copyright|\(c\))(?![^\n]*(?:notice|holder|owner|treaty))(?:(?<=copyright)[^\n]*(?:{_YEAR}|\(c\)|©)|(?<=\))[^\n]*{_YEAR})|©(?![^\n]*(?:notice|holder|owner)))[^\n]*"
#: The same without a year, by the capital letter of the name.
NAMED_LINE = r"(^|\n)[ \t#*/;-]*Copyright[ \t]+(?!(?i:[^\n]*(?:notice|holder|owner|treaty|law|licen[cs])))(?:by[ \t]+)?\p{Lu}[^\n]*"
#: Wherever it stands.
RIGHTS = r"all rights reserved\.?"
OTHER = r"[^\p{L}\p{N}]+"


def _without_notices(x: Column) -> Column:
    """Drops what stands between "copyright" with a year or sign and the opening of a licence,
    however long it is, unless "copyright" stands there again."""

    def after(part: Column) -> Column:
        at = F.regexp_instr(F.substring_index(part, "copyright", 1), F.lit(OPENING))
        return F.when(at > 0, F.concat(F.lit(" "), F.substring(part, at, F.length(part)))).otherwise(F.concat(F.lit("copyright"), part))

    def joined(parts: Column) -> Column:
        return F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), after), ""))

    # The pattern starts with letters, which are found fast; the text is split once for all its uses.
    parts = F.split(x, r"copyright(?<![\p{L}\p{N}]copyright)(?=" + MARK + ")")
    return F.get(F.transform(F.array(parts), joined), 0)


def canonical(text: Column) -> Column:
    x = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), NAMED_LINE, "\n"))
    for notice in HOLDERS:
        x = F.regexp_replace(x, notice, " ")
    x = _without_notices(x)
    x = F.regexp_replace(F.regexp_replace(x, HOLDER_LINE, "\n"), RIGHTS, " ")
    x = F.regexp_replace(x, OTHER, " ")
    for variant, kept in SPELLINGS:
        x = F.replace(x, F.lit(variant), F.lit(kept))
    return F.trim(x)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """(license_id, known_digest): as many rows as texts are given, so safe to broadcast. By
    default the texts of KNOWN and the digests of STANDARD."""
    rows = [F.struct(F.lit(k).alias("license_id"), F.lit(t).alias("text")) for k, t in (KNOWN if known is None else known).items()]
    found = spark.range(1).select(F.inline(F.array(*rows))).select("license_id", digest(F.col("text")).alias("known_digest"))
    if known is not None:
        return found
    rows = [F.struct(F.lit(k).alias("license_id"), F.lit(d).alias("known_digest")) for k, d in STANDARD.items()]
    return found.union(spark.range(1).select(F.inline(F.array(*rows))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, text_digest, license_id, n_notices, notice_ids.

    license_id: the licence that the entire text is, or null. n_notices and notice_ids: how
    many lines are a known notice, and which, sorted. Null, empty and punctuation-only texts are
    all the empty text, which is no licence. Repeated rows are reported each; an empty table
    gives an empty result; other columns are not read."""
    table = F.broadcast(known_digests(docs.sparkSession, known))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    whole = docs.withColumn("text_digest", digest(F.col("text"))).join(table, F.col("text_digest") == F.col("known_digest"), "left")
    speaks = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.lower(line).rlike("licen[cs]|public domain"))
    matched = F.transform(speaks, lambda line: digest(line))
    pairs = [F.lit(x) for row in table.select("known_digest", "license_id").collect() for x in row]
    lookup = F.create_map(*pairs)
    found = whole.withColumn("found", F.filter(F.transform(matched, lambda d: F.try_element_at(lookup, d)), lambda x: x.isNotNull()))
    return found.select("doc_id", "text_digest", "license_id", F.size("found").cast("long").alias("n_notices"), F.array_join(F.sort_array(F.array_distinct("found")), ",").alias("notice_ids"))
