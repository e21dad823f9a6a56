"""Personal data by candidate gradient boosting, in DataFrame operations only.

High-recall generators propose overlapping spans of several kinds. Boosted
trees score each proposal from its format (digits, separators, checksums) and
its context (cue words, the character before it). The trees are trained on the
proposals of half of all documents, labelled by the strict patterns below,
together with altered copies that break a check; thresholds are calibrated per
kind on the other half. Proposals of equal features and label are one weighted
row, so the training table grows with the formats that occur, not with the
documents. Scoring needs no
shuffle: the trees become one SQL expression over the proposals of a row.

Strict ("base") matches always stay. A selected proposal is added where it
overlaps no base span and no better proposal.

Defined results: a null or empty text has no spans; positions are code points,
the end is exclusive; base spans are leftmost and not overlapping per kind; a
match that fails its check is dropped without a retry; equal scores go to the
earlier kind, then the earlier span; repeated rows are treated each; without
proposals of both labels to train on there is no model and only base spans
are returned.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.shared import id_text, written

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
# The strict patterns, written so that no match backtracks more than linearly:
# a possessive repeat can't give back anything the rest could use, and a match
# starts at the first character of its run (or right behind the last match).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
# Generators: (kinds proposed, pattern). They overlap and accept far more than the strict patterns.
NUMBER = r"(?<![0-9A-Za-z])[+(]?[0-9][0-9().\x20/_-]{4,30}[0-9](?![0-9A-Za-z])"
GENERATORS = (
    (("email",), r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)*+"),
    (("ip", "card", "phone"), NUMBER),
    (("secret",), r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+|[A-Z0-9]{16,}+(?![A-Za-z0-9+/_-]))"),
)
#: Any text with a proposal matches this.
ANY = r"@|[0-9]|[\[(]at[\])]|[A-Z]{16}"
SECRET_FORMAT = r"^AKIA[0-9A-Z]{16}$"
SECRET_CUE = r"(?i)(?:password|passwd|secret|token|api_?key)\s*[=:]\s*[\"']?$"
CUE = r"(?i)(?:mail|phone|tel|call|fax|mobile|card|visa|ip|host|server|address|password|passwd|secret|token|key)\W*$"
CONTEXT = 24
#: Boosting rounds, depth, precision asked of a threshold.
ROUNDS, DEPTH, PRECISION = 16, 4, 0.99
LEAST_SUPPORT = 20
#: Margin asked of a kind that has fewer than ``LEAST_SUPPORT`` proposals of such a margin to calibrate on (a probability of 0.88).
DEFAULT_MARGIN = 1.0
#: Items of a run in ``scan``.
RUN = 128
SPAN = "array<struct<s:int,e:int,t:string>>"
PLAIN = "array<struct<s:int,k:int,e:int>>"
MARKED = "array<struct<s:int,m:double,k:int,e:int>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once for each use in a lambda."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, state: Column, step, outs: str) -> Column:
    """Left to right over an array: ``step(state, item)`` gives (new state, array of outputs).

    Spark copies an array to append to it, so outputs are gathered in runs of
    ``RUN`` items, which keeps texts with very many spans far from quadratic.
    """
    none = F.array().cast(outs)

    def inner(acc, x):
        new, out = step(acc["st"], x)
        return F.struct(new.alias("st"), F.concat(acc["outs"], out).alias("outs"))

    def outer(acc, run):
        done = F.aggregate(run, F.struct(acc["r"]["st"].alias("st"), none.alias("outs")), inner)
        return F.struct(done.alias("r"), F.concat(acc["parts"], F.array(acc["r"]["outs"])).alias("parts"))

    def whole(xs):
        last = F.floor((F.size(xs) - 1) / RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(xs, i * RUN + 1, RUN))
        start = F.struct(F.struct(state.alias("st"), none.alias("outs")).alias("r"), F.array().cast(f"array<{outs}>").alias("parts"))
        return F.aggregate(runs, start, outer, lambda acc: F.flatten(F.concat(acc["parts"], F.array(acc["r"]["outs"]))))

    return let(items, whole)


def found(text: Column, pattern: str) -> Column:
    """Spans (s, e, t) of a pattern's matches, from the texts of matches and of the gaps before them."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(hits, gaps, lambda t, g: F.struct(g.alias("g"), F.length(t).alias("n"), t.alias("t")))
    pairs = F.filter(pairs, lambda x: x["t"].isNotNull())  # the gap behind the last match

    def step(at, x):
        s = at + x["g"]
        return s + x["n"], F.array(F.struct(s.alias("s"), (s + x["n"]).alias("e"), x["t"].alias("t")))

    return scan(pairs, F.lit(0), step, SPAN)


def digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """Whether 12 to 19 digits pass the Luhn check."""
    d = digits(t)
    n = F.length(d)
    parts = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    total = F.aggregate(parts, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when((n >= 12) & (n <= 19), total % 10 == 0).otherwise(False)


def valid(kind: str, t: Column) -> Column:
    """The check of a strict match."""
    if kind == "ip":
        return t.rlike(OCTETS)
    if kind == "card":
        return luhn(t)
    if kind == "phone":
        return F.length(digits(t)).between(9, 15)
    return F.lit(True)


def checked(kind: str):
    return lambda x: valid(kind, x["t"])


def placed(k: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"))


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the strict matches, by start, then kind."""
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    of = []
    for k, kind in enumerate(BASE_KINDS):
        may = text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else F.lit(True)
        own = F.transform(F.filter(found(text, BASE[kind]), checked(kind)), placed(k))
        of.append(F.when(may, own).otherwise(none))
    return F.when(text.contains("@") | text.rlike("[0-9]"), F.array_sort(F.concat(*of))).otherwise(none)


def proposals(text: Column) -> Column:
    """array<struct<s, k, e, t, left>>: the generators' spans with the text before them."""
    none = F.array().cast("array<struct<s:int,k:int,e:int,t:string,left:string>>")

    def proposed(k):
        def one(x):
            left = F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))
            return F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["t"].alias("t"), left.alias("left"))

        return one

    of = []
    for kinds, pattern in GENERATORS:
        may = text.contains("@") | text.rlike(r"[\[(]at[\])]") if kinds == ("email",) else F.lit(True)
        spans = found(text, pattern)
        for kind in kinds:
            of.append(F.when(may, F.transform(spans, proposed(KINDS.index(kind)))).otherwise(none))
    return F.when(text.rlike(ANY), F.concat(*of)).otherwise(none)


def features(c) -> list[Column]:
    """Format and context features of a proposal (a struct with k, t, left)."""
    t, left = c["t"], c["left"]

    def count(pattern):
        return F.length(F.regexp_replace(t, f"[^{pattern}]", "")).cast("double")

    def flag(test):
        return F.when(test, 1.0).otherwise(0.0)

    changes = F.size(F.regexp_extract_all(t, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), F.lit(0)))
    groups = F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0)))
    return [
        c["k"].cast("double"), F.length(t).cast("double"), count("0-9"), count("A-Za-z"), count("A-Z"), count(r"\x20().-"), count("."),
        flag(t.startswith("+")), flag(t.rlike(r"@[A-Za-z0-9-]+\.")), flag(luhn(t)), flag(t.rlike(OCTETS)), groups.cast("double"),
        changes.cast("double"), flag(left.rlike(CUE)), flag(left.rlike(r"[=:\"']\s*$")), flag(left.rlike(r"\w$")), flag(t.rlike("[a-z]")),
    ]


def strict_label(c) -> Column:
    """Label of a proposal: a strict match of its kind as a whole, or a known secret format."""
    out = c["t"].rlike(SECRET_FORMAT) | c["left"].rlike(SECRET_CUE)
    for k, kind in enumerate(BASE_KINDS):
        out = F.when(c["k"] == k, c["t"].rlike(f"^(?:{BASE[kind]})$") & valid(kind, c["t"])).otherwise(out)
    return out


def altered(c) -> Column:
    """A proposal's copy with other digits: checksums, octets and formats mostly break."""
    t = F.when(c["k"] == 0, F.regexp_replace(c["t"], r"@.*", "@")).when(c["k"] == 3, F.substring(c["t"], 2, 8)).when(
        c["k"] == 4, F.regexp_replace(c["t"], "[0-9]", "a")).otherwise(F.translate(c["t"], "0123456789", "9876501234"))
    left = F.when(c["k"] == 4, F.regexp_replace(c["left"], r"\W*$", " ")).otherwise(c["left"])
    return F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), t.alias("t"), left.alias("left"))


def training_rows(docs: DataFrame) -> DataFrame:
    """(f, k, label, half, n): features of the proposals in all documents, and how many proposals share them."""
    with_any = docs.where(F.col("text").rlike(ANY)).select("doc_id", "text")
    rows = with_any.select("doc_id", F.explode(proposals(F.col("text"))).alias("c"))
    label = strict_label(F.col("c"))
    twice = F.explode(F.array(F.struct(F.col("c").alias("c"), F.lit(False).alias("changed")), F.struct(altered(F.col("c")).alias("c"), F.lit(True).alias("changed")))).alias("x")
    rows = rows.select("doc_id", label.alias("strict"), twice).select("doc_id", "strict", "x.*").where("not changed or strict")
    # an altered copy that still passes its check is no counter-example
    ok = F.when(F.col("c.k") == 1, valid("ip", F.col("c.t"))).when(F.col("c.k") == 2, luhn(F.col("c.t"))).otherwise(False)
    rows = rows.where(~(F.col("changed") & ok))
    each = rows.select(F.array(*features(F.col("c"))).alias("f"), F.col("c.k").alias("k"), (F.col("strict") & ~F.col("changed")).cast("double").alias("label"),
                       F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half"))
    return each.groupBy("f", "k", "label", "half").agg(F.count(F.lit(1)).alias("n"))


def tree_column(node, f: Column) -> Column:
    """A fitted tree as nested conditions over the feature array."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[split.featureIndex()] <= float(split.threshold()), tree_column(node.leftChild(), f)).otherwise(tree_column(node.rightChild(), f))


class Model:
    """Fitted trees with their weights, and the margin asked of each kind (None: never)."""

    def __init__(self, trees, weights, thresholds):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def margin(self, f: Column) -> Column:
        return sum((tree_column(t, f) * w for t, w in zip(self.trees, self.weights)), F.lit(0.0))


def fit(docs: DataFrame) -> Model | None:
    """Trees and thresholds from all rows of (doc_id, text); None without proposals of both labels."""
    rows = written(training_rows(docs), "proposals")
    present = {r["label"] for r in rows.where("half = 0").select("label").distinct().collect()}
    if len(present) < 2:
        return None
    train = rows.where("half = 0").select(array_to_vector("f").alias("features"), "label", F.col("n").cast("double").alias("weight"))
    fitted = GBTClassifier(weightCol="weight", maxIter=ROUNDS, maxDepth=DEPTH, seed=7, maxBins=32).fit(train)
    model = Model([t._java_obj.rootNode() for t in fitted.trees], list(fitted.treeWeights), {})
    margin = rows.where("half = 1").withColumn("m", F.floor(model.margin(F.col("f")) * 20))
    bins = margin.groupBy("k", "m").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good")).collect()  # a few hundred rows
    for k in range(len(KINDS)):
        n = good = 0
        model.thresholds[k] = None
        for r in sorted((r for r in bins if r["k"] == k), key=lambda r: -r["m"]):
            n, good = n + r["n"], good + r["good"]
            if n >= LEAST_SUPPORT and good >= PRECISION * n and r["m"] >= 0:
                model.thresholds[k] = r["m"] / 20
        if model.thresholds[k] is None and sum(r["n"] for r in bins if r["k"] == k and r["m"] >= DEFAULT_MARGIN * 20) < LEAST_SUPPORT:
            model.thresholds[k] = DEFAULT_MARGIN
    return model


def clear(marked: Column) -> Column:
    """Of spans by start (a null margin marks a base span), the proposals that overlap no base span."""

    def forward(end, x):  # end: the largest end of a base span so far
        base = x["m"].isNull()
        keep = base | (x["s"] >= end)
        return F.when(base, F.greatest(end, x["e"])).otherwise(end), F.when(keep, F.array(x)).otherwise(F.array().cast(MARKED))

    def backward(start, x):  # start: the smallest start of a base span behind
        base = x["m"].isNull()
        keep = ~base & (x["e"] <= start)
        return F.when(base, x["s"]).otherwise(start), F.when(keep, F.array(x)).otherwise(F.array().cast(MARKED))

    ahead = scan(marked, F.lit(0), forward, MARKED)
    return F.reverse(scan(F.reverse(ahead), F.lit(2147483647), backward, MARKED))


def first_apart(marked: Column) -> Column:
    """Of proposals by start, at equal starts the best first, those that overlap none taken before."""

    def step(end, x):
        keep = x["s"] >= end
        out = F.array(F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
        return F.when(keep, x["e"]).otherwise(end), F.when(keep, out).otherwise(F.array().cast(PLAIN))

    return scan(marked, F.lit(0), step, PLAIN)


def all_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text, ...) with ``base`` and ``spans``: arrays of (s, k, e) by start, then kind."""
    docs = docs.withColumn("base", base_spans(F.col("text")))
    if model is None or all(t is None for t in model.thresholds.values()):
        return docs.withColumn("spans", F.col("base"))
    asked = F.array(*(F.lit(model.thresholds[k]).cast("double") for k in range(len(KINDS))))

    def scored(c):
        m = let(F.array(*features(c)), model.margin)
        return F.struct(c["s"].alias("s"), (-m).alias("m"), c["k"].alias("k"), c["e"].alias("e"))

    chosen = F.filter(F.transform(proposals(F.col("text")), scored), lambda c: F.coalesce(-c["m"] >= asked[c["k"]], F.lit(False)))
    as_marked = F.transform("base", lambda b: F.struct(b["s"].alias("s"), F.lit(None).cast("double").alias("m"), b["k"].alias("k"), b["e"].alias("e")))
    # a null margin sorts first, so a base span stands before the proposals of its start
    added = first_apart(clear(let(F.concat(as_marked, chosen), lambda x: F.array_sort(x))))
    none = F.array().cast(PLAIN)
    docs = docs.withColumn("added", F.when(F.col("text").rlike(ANY), added).otherwise(none))
    return docs.withColumn("spans", F.when(F.size("added") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))).drop("added")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def same_kind(k: int):
    return lambda x: x["k"] == k


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_<kind> of the base spans, base_sha256, spans, n_added."""
    docs = id_text(docs)
    out = all_spans(docs, fit(docs))
    counts = [F.size(F.filter("base", same_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                      (F.size("spans") - F.size("base")).alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each span's text replaced by its kind in brackets; other columns stay (n_chars follows)."""
    own = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    spans = all_spans(own, fit(own.select("doc_id", "text")))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    text = F.col("text")

    def step(at, x):
        s = F.greatest(x["s"], at)
        part = F.concat(F.substring(text, at + 1, s - at), F.when(x["s"] >= at, names[x["k"]]).otherwise(""))
        done = x["e"] <= at
        return F.greatest(at, x["e"]), F.when(done, F.array().cast("array<string>")).otherwise(F.array(part))

    end = F.array_max(F.transform("spans", lambda x: x["e"]))
    clean = F.concat(F.array_join(scan(F.col("spans"), F.lit(0), step, "array<string>"), ""), F.substring(text, end + 1, F.length(text)))
    clean = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(clean)
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") == 0, F.col("row.n_chars")).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType)
    return spans.select(*((changed.get(c, F.col("row")[c])).alias(c) for c in docs.columns))
