"""Personal data: candidate spans scored by gradient-boosted trees.

Base patterns with their checks give certain spans. High-recall generators
propose further, overlapping candidates (loosely written addresses and
numbers). Each candidate has format features (length, digits, separators,
groups, check digits) and context features (telling words before it, the
characters around it). Boosted trees are fitted on all candidates, equal ones
as one with a weight. The labels don't come from the base patterns: an account number
is labelled by its check digits (mod 97), an address by its plain form, a
number as a card by its check digit and issuer or as a telephone number by
its size and a telling word, a span that a base check confirms as such. These
are weak labels: a telephone number that nothing tells of counts as a number.
For each kind, the score from which on enough held-out candidates apart from
all base spans are right is the threshold; such candidates above it are added.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import cut, sub_batches, text_key

CHUNK = 1 << 21


def digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def luhn(s: str) -> bool:
    double = {str(d): sum(divmod(2 * d, 10)) for d in range(10)}
    return (sum(map(int, s[-1::-2])) + sum(double[c] for c in s[-2::-2])) % 10 == 0


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def matches(pattern: str, flags: int = 0):
    """A function listing (start, end) of a pattern's matches in a text; for
    patterns whose matches are bounded or can't fail after a long run."""
    compiled = re.compile(pattern, flags)
    return lambda text: (m.span() for m in compiled.finditer(text))


def around(marker: str, domain: str, gap: bool, flags: int = 0):
    """The same for `LOCAL` characters, a marker and a domain (with `gap`, one
    blank may be before the marker). The marker is looked for first and the run
    before it read backwards, so no start of a long run is tried in vain."""
    marker, domain = re.compile(marker, flags), re.compile(domain, flags)

    def find(text: str):
        done = 0
        for m in marker.finditer(text):
            end = m.start() - 1 if gap and m.start() > done and text[m.start() - 1] == " " else m.start()
            start = end
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            rest = domain.match(text, m.end()) if start < end else None
            if rest:
                done = rest.end()
                yield start, done
    return find


def dotted_fours(text: str):
    """(start, end) of every four numbers with dots between, leftmost first."""
    for m in re.finditer(r"[0-9]+(?:\.[0-9]+)*", text):
        at, groups = m.start(), m[0].split(".") if "." in m[0] else []
        for i in range(0, len(groups) - 3, 4):
            size = sum(map(len, groups[i:i + 4])) + 3
            yield at, at + size
            at += size + 1


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


#: Base kinds in their listed order, (kind, what a text must hold, matches, check).
BASE = [
    ("email", re.compile("@"), around("@", r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", False), lambda s: True),
    ("ip", re.compile(r"[0-9]\.[0-9]"), dotted_fours, lambda s: all(map(small, s.split(".")))),
    ("card", re.compile("[0-9]"), matches(r"[0-9]([\x20-]?[0-9])+"), lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", re.compile(r"\+[0-9]"), matches(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 8 <= len(digits(s)) <= 15),
]
#: Further candidates: (kind, what a text must hold, matches).
PROPOSED = [
    ("address", re.compile(r"@|[\[(]at[\])]", re.I), around(
        r"@|\[at\]|\(at\)", r"\x20?[A-Za-z0-9-]+(?:(?:\.|\x20\.\x20?|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]+)+", True, re.I)),
    ("number", re.compile("[0-9]{2}"), matches(r"\+?\(?[0-9](?:[0-9\x20()\-/]|\.(?!\x20)){5,40}[0-9]")),
    ("dotted", re.compile(r"[0-9]\.[0-9]"), matches(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,7}(?![0-9.])")),
    ("account", re.compile("[A-Z]{2}[0-9]{2}"), matches(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
]
#: Telling words before a span, one feature for each group.
WORDS = [re.compile(p, re.I) for p in (
    r"mail|contact|write", r"phone|tel\b|tel\.|call|fax|mobile|cell", r"card|visa|credit|payment|account|iban", r"\bip\b|host|server|login|address")]

AT, DOT = re.compile(r"\x20?(?:@|\[at\]|\(at\))\x20?", re.I), re.compile(r"\x20?(?:\[dot\]|\(dot\))\x20?|\x20\.\x20?", re.I)
PLAIN_ADDRESS = re.compile(r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
NO_TELEPHONE = re.compile(r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}|[0-9]+\.[0-9]+")


def account_checks(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def checks(s: str) -> tuple[bool, bool, bool, bool]:
    """Whether a candidate's own form says that it is an account number, an
    address in plain or altered form, a card number, or may be a telephone number."""
    d = digits(s)
    return (re.match("[A-Z]{2}[0-9]{2}", s) is not None and account_checks(s), PLAIN_ADDRESS.fullmatch(DOT.sub(".", AT.sub("@", s))) is not None,
            13 <= len(d) <= 19 and d[0] in "3456" and luhn(d), 7 <= len(d) <= 15 and not NO_TELEPHONE.fullmatch(s))


def right(text: str, start: int, end: int, kind: str) -> bool:
    """The weak label of a candidate, whatever the base patterns find."""
    account, address, card, telephone = checks(text[start:end])
    if kind in ("account", "address"):
        return account if kind == "account" else address
    before = text[max(0, start - 30):start]
    return card if kind == "number" and card else telephone and WORDS[1].search(before) is not None


def describe(text: str, start: int, end: int, kind: int) -> list[float]:
    s, before, after = text[start:end], text[max(0, start - 30):start], text[end:end + 1]
    d = digits(s)
    groups_ = re.findall("[0-9]+", s)
    sizes = [len(x) for x in groups_] or [0]
    letters = sum(c.isalpha() for c in s)
    parts = re.split(r"\.|\[dot\]|\(dot\)", s)
    return [float(x) for x in (
        *(kind == k for k in range(len(PROPOSED))), len(s), len(d), letters, len(sizes), max(sizes), min(sizes), s.count(" "), s.count("-"),
        s.count("."), s[0] == "+", "(" in s, "@" in s, len(parts[-1].strip()),
        *(bool(w.search(before)) for w in WORDS), after.isalnum(), *checks(s))]


def spans_in(text: str) -> tuple[list, list]:
    """Base spans (kind, start, end) by kind and start, and candidates
    (kind, start, end, confirmed, features); those of a kind don't overlap."""
    base, hit = [], {}
    for kind, test, find, check in BASE:
        if test.search(text):
            found = [(kind, a, z) for a, z in find(text) if check(text[a:z])]
            base += found
            hit.update((f[1:], True) for f in found)
    more = []
    for k, (kind, test, find) in enumerate(PROPOSED):
        if test.search(text):
            more += [(kind, a, z, (a, z) in hit or right(text, a, z, kind), describe(text, a, z, k)) for a, z in find(text)]
    return base, more


SPAN = "struct<kind:string,start:int,end:int>"


def candidates(rows: DataFrame) -> DataFrame:
    """id, key, base (array of spans), more (array of candidates with features)."""
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    cand = pa.struct([*span, ("confirmed", pa.bool_()), ("features", pa.list_(pa.float64()))])

    def run(batches):
        for b in sub_batches(batches, "text", CHUNK):
            both = [spans_in(t or "") for t in b.column("text").to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), x)) for x in p[0]] for p in both]
            more = [[dict(zip(("kind", "start", "end", "confirmed", "features"), x)) for x in p[1]] for p in both]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(cand))], ["id", "key", "base", "more"])

    return rows.mapInArrow(run, f"id {kind}, key bigint, base array<{SPAN}>, more array<struct<kind:string,start:int,end:int,"
                                "confirmed:boolean,features:array<double>>>")


def apart() -> Column:
    """Whether a candidate overlaps no base span."""
    return ~F.exists("base", lambda s: (s["start"] < F.col("c.end")) & (s["end"] > F.col("c.start")))


def fit(found: DataFrame, task_rows: int, precision: float, trees: int):
    """(model, thresholds by kind) from all candidates. Equal ones (features,
    label, kind, overlap, fold) are one row with their number as its weight, which
    is what the trees would make of the single rows. Each kind counts as much as
    any other, those that overlap a base span and those that don't apart. A fifth,
    by their hash, is held out of the trees, and all of it decides the thresholds.
    None if one class is missing or no score of any kind reaches the precision.
    A task has some `task_rows` of the rows."""
    fold = F.pmod(F.xxhash64("id", "key", "c.start", "c.kind"), F.lit(5)) == 0
    rows = found.select(F.col("c.confirmed").cast("double").alias("label"), F.col("c.features").alias("features"),
                        F.col("c.kind").alias("kind"), apart().alias("apart"), fold.alias("held"))
    alike = cut(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")))
    sizes = alike.groupBy("kind", "apart", "held", "label").agg(F.sum("n").alias("n")).collect()  # eight for each kind at most
    if len({(held, label) for _, _, held, label, _ in sizes}) < 4:
        return None
    groups = {}
    for kind, own, _, _, n in sizes:
        groups[kind, own] = groups.get((kind, own), 0) + n
    share = F.lit(0.0)
    for (kind, own), n in groups.items():
        share = F.when((F.col("kind") == kind) & (F.col("apart") == own), sum(groups.values()) / (len(groups) * n)).otherwise(share)
    tasks = max(4, alike.count() // task_rows + 1)
    alike = alike.repartition(tasks, *rows.columns).sortWithinPartitions(*rows.columns)  # the same trees in every run
    alike = alike.withColumn("weight", F.col("n") * share).withColumn("features", array_to_vector("features"))
    model = GBTClassifier(maxIter=trees, maxDepth=4, stepSize=0.2, seed=17, weightCol="weight").fit(alike.filter("NOT held"))
    held = model.transform(alike.filter("held AND apart")).select(
        "kind", "label", "n", F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("score"))
    counts = {(k, s): (n, good) for k, s, n, good in held.groupBy("kind", "score").agg(  # 101 rows a kind
        F.sum("n"), F.sum(F.col("n") * F.col("label"))).collect()}
    thresholds = {}
    for kind in {k for k, _ in counts}:
        n = good = 0
        for score in range(100, 49, -1):
            more = counts.get((kind, score), (0, 0))
            n, good = n + more[0], good + more[1]
            if n >= 20 and good >= precision * n:
                thresholds[kind] = score / 100
    return (model, thresholds) if thresholds else None


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_rows: int = 20_000,
                       precision: float = 0.995, trees: int = 12) -> DataFrame:
    """One row for each input row: `id_col`, row_key (hash of the text), base
    (array of kind, start, end in code points, by kind as listed and start),
    added (the method's further spans, by start).

    Without enough examples of either class (of a kind) nothing (of it) is added. Null and empty
    texts have no spans, texts of any length are whole and read in linear time;
    equal rows get equal spans; an empty table gives an
    empty result; other columns are not read, whatever their names; a null id
    is kept.
    """
    rows = cut(candidates(docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))))
    found = rows.select("id", "key", "base", F.explode("more").alias("c"))
    fitted = fit(found, task_rows, precision, trees)
    none = F.array().cast(f"array<{SPAN}>")
    if fitted is None:
        return rows.select(F.col("id").alias(id_col), F.col("key").alias("row_key"), "base", none.alias("added"))
    model, thresholds = fitted
    least = F.lit(2.0)
    for kind, score in thresholds.items():
        least = F.when(F.col("c.kind") == kind, score).otherwise(least)
    scored = model.transform(found.filter(apart()).select("id", "key", "c", array_to_vector("c.features").alias("features")))
    added = scored.filter(vector_to_array("probability")[1] >= least).groupBy("id", "key").agg(
        F.sort_array(F.collect_set(F.struct("c.start", "c.end", "c.kind"))).alias("new")).withColumnsRenamed({"id": "id_", "key": "key_"})
    both = rows.join(added, rows["id"].eqNullSafe(added["id_"]) & (rows["key"] == added["key_"]), "left")
    new = F.transform("new", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return both.select(F.col("id").alias(id_col), F.col("key").alias("row_key"), "base", F.coalesce(new, none).alias("added"))
