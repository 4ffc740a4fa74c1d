"""Secret scans with corpus-wide ownership counts, in SQL functions only.

Base patterns and known credential formats give candidate spans in each
text. Every candidate value is hashed, and its hash is counted over the
corpus by distinct repository (the row) and owner: first within (hash,
owner), then by hash, so a value that is copied everywhere is combined before
it moves. A value held by `widely` owners or more is a copied example; one
that fewer hold is an owner-specific live credential, unless its kind needs
more than the form (a body, different characters, no placeholder) and it lacks it.
Base spans are always reported; spans of the further patterns only if they
aren't copied examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import counted_side, cut, text_key
from quartermaster.llm.quality import held

#: Base kinds in their listed order, then the formats the method
#: adds: (kind, cheap test, pattern, group that holds the value, least characters of that group)
KINDS = [
    ("assign", r"(?i:passw|secret|token|api_?key)",
     r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", "AKIA", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"[0-9a-f]{24}", r"([0-9a-f]+)", 1, 24),
]
KEY = "(?:[A-Z0-9]+ )*PRIVATE KEY"
#: A private key is its body up to the footer, whatever lines it has; without a footer, the characters a key may have.
ADDED = [
    ("github", r"gh[opsur]_", r"(gh[opsur]_[A-Za-z0-9]{36,})", 1, 40),
    ("stripe", r"[rs]k_live_", r"([rs]k_live_[A-Za-z0-9]{16,})", 1, 24),
    ("slack", r"xox[abeprs]-", r"(xox[abeprs]-[A-Za-z0-9-]{10,})", 1, 15),
    ("google", r"AIza", r"(AIza[A-Za-z0-9_-]{35})", 1, 39),
    ("jwt", r"eyJ", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 24),
    ("pem", r"-----BEGIN", rf"-----BEGIN {KEY}-----((?>(?s:.*?)(?=-----))(?=-----END )|[A-Za-z0-9+/=\s\\\\\"',]*+)(?:-----END {KEY}-----)?", 1, 32),
]
SPAN = "array<struct<kind:string,rank:int,start:int,end:int,value:string>>"


def spans_of(text: Column, kind: str, rank: int, test: str, pattern: str, group: int, least: int) -> Column:
    """The leftmost non-overlapping matches, those of too few characters
    dropped afterwards. The texts between the matches give the positions."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.arrays_zip(
        between.alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), start.alias("start"),
                        (start + x["size"]).alias("end"), x["value"].alias("value"))
        keep = F.length(x["value"]) >= least
        return F.struct((start + F.coalesce(x["size"], F.lit(0))).alias("at"),
                        F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    all_ = F.aggregate(found, start, add, lambda acc: acc["spans"])
    return F.when(text.rlike(test), all_).otherwise(none).cast(SPAN)


def bare(kind: Column, value: Column) -> Column:
    """A private key without line ends and quotes, so that its copies are equal; other values as they are."""
    return F.when(kind == "pem", F.regexp_replace(value, r"""\s|\\[nrt]|["',\\]""", "")).otherwise(value)


#: Values that stand for a secret: such words only, with or without signs between them.
PLACEHOLDER = ("(?i)(?:(?:your|my|the|some|insert|enter|replace|change|with|me|it|this|here|example|sample|dummy|test|fake|placeholder|redacted|hidden|todo|none|"
               "null|nil|undefined|true|false|required|optional|user|new|old|password|passwd|passw|pass|secret|token|api|key|access|auth|client|string|value|"
               "default|name|env|getenv|get|set|self|config|settings|os|process|environ|request|form|input|x++)[_.=/+-]*+)+")


def looks_live(kind: Column, value: Column) -> Column:
    """Whether a value that few owners hold is a credential. The known formats
    are; a private key needs a body; an assigned value has different characters
    enough for its length and is no placeholder; a hash has them too, letters
    and digits mixed."""
    chars = F.size(F.array_remove(F.array_distinct(F.split(value, "")), ""))
    least = F.greatest(F.lit(3), F.least(F.lit(6), F.ceil(F.length(value) / 3)))
    placeholder = (F.length(value) <= 80) & value.rlike(f"^{PLACEHOLDER}$")
    return (F.when(kind == "pem", value.rlike("[A-Za-z0-9+/=]{32}"))
            .when(kind == "assign", (chars >= least) & ~placeholder)
            .when(kind == "hex", (chars >= least) & value.rlike("[0-9]") & value.rlike("[a-f]")).otherwise(F.lit(True)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", widely: int = 3) -> DataFrame:
    """One row for each input row: `id_col`, row_key (hash of the text), spans
    (array of kind, rank, start, end in code points, end exclusive, digest,
    repositories, owners, live; by start, then kind as listed).

    A repository is a row, an owner a value of `owner_col` (null is an owner
    of its own). Null and empty texts have no spans; equal rows count as two
    repositories and are judged alike; an empty table gives an empty result;
    other columns are not read, whatever their names; a null id is kept.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = held(docs.select(F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), text_key(text_col).alias("row_key"), text.alias("text")),
                **{kind: spans_of(F.col("text"), kind, i, *rest) for i, (kind, *rest) in enumerate(KINDS + ADDED)})
    found = F.concat(*[F.col(k[0]) for k in KINDS + ADDED])
    found = F.transform(found, lambda x: x.withField("value", bare(x["kind"], x["value"])))
    rows = cut(rows.select("id", "owner", "row_key", F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"),
        F.sha2(x["value"], 256).alias("digest"), looks_live(x["kind"], x["value"]).alias("random"))).alias("found")))

    values = rows.filter(F.size("found") > 0).select(
        "id", "row_key", "owner", F.explode(F.array_distinct(F.transform("found", lambda x: x["digest"]))).alias("digest"))
    owned = values.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(
        F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    facts = values.join(owned, "digest").groupBy("id", "row_key").agg(
        F.collect_set(F.struct("digest", "repositories", "owners")).alias("facts"))
    both = rows.join(facts.withColumnsRenamed({"id": "id_", "row_key": "key_"}),
                     rows["id"].eqNullSafe(F.col("id_")) & (rows["row_key"] == F.col("key_")), "left")
    fact = F.map_from_entries(F.transform("facts", lambda f: F.struct(f["digest"], F.struct(f["repositories"], f["owners"]))))

    def told(x):
        f = F.col("fact")[x["digest"]]
        return F.struct(x["start"], x["rank"], x["end"], x["kind"], x["digest"], f["repositories"].alias("repositories"),
                        f["owners"].alias("owners"), (x["random"] & (f["owners"] < widely)).alias("live"))

    spans = F.sort_array(F.filter(F.transform("found", told), lambda x: (x["rank"] < len(KINDS)) | (x["owners"] < widely)))
    return held(both.select("id", "row_key", "found", "facts"), fact=fact).select(
        F.col("id").alias(id_col), "row_key", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every live span, overlaps merged, replaced by `mark`; other rows and columns unchanged."""
    def own(name: str) -> str:
        while name in docs.columns:
            name += "_"
        return name

    found, of_id, of_key = own("live"), own("live_id"), own("live_key")
    live = counted_side(spans.select(F.col(id_col).alias(of_id), F.col("row_key").alias(of_key), F.transform(
        F.filter("spans", lambda x: x["live"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(found)
    ).filter(F.size(found) > 0).distinct(), weight=F.size(found) + 1)
    both = docs.join(live, docs[id_col].eqNullSafe(live[of_id]) & (text_key(text_col) == live[of_key]), "left")
    text = F.col(text_col)

    def step(acc, x):
        new = x["start"] >= acc["at"]
        piece = F.when(new, F.concat(text.substr(acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.concat(acc["out"], piece).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    clean = F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    return both.withColumn(text_col, F.when(F.col(found).isNull(), text).otherwise(clean)).select(*docs.columns)
