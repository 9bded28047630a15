"""Secret scan: candidate strings, and a random forest that removes the false findings.

All steps are DataFrame functions; the forest is Spark's own.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playline.llm.expressions import named, packed, words
from playline.session import scratch_path, stage

#: Labelled findings that a fit takes at most, chosen by a hash of the finding.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 7
#: A word of the corpus counts as a dictionary word from so many occurrences on.
DICTIONARY_COUNT = 20
#: Characters of the text kept on each side of a candidate.
NEAR = 60
#: Bits that an assigned value must have to be labelled a secret without a known format: what six
#: letters of one case chosen at random have.
LEAST_BITS = 28.0
#: The log probability of a pair of letters that no dictionary word has.
UNSEEN = -12.0

#: A private key in PEM or PGP form, with header lines; without its end, as far as lines of it go.
KEY_BLOCK = (
    "-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:\\s*[A-Za-z][A-Za-z0-9-]*:[^\\n]*\\n){0,20}"
    "(?:[A-Za-z0-9+/=\\s\\\\]*-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    "|(?:(?:\\s|\\\\[nr])*[A-Za-z0-9+/=]{24,}){0,400}(?:(?:\\s|\\\\[nr])+[A-Za-z0-9+/]+={1,2})?)"
)
#: Runs of 16 or more key characters with a digit among them, or a key in its frame.
CANDIDATE = (
    "(" + KEY_BLOCK + "|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2})"
)
#: A value assigned to the name of a credential, quoted or up to the next space; the value ends the
#: match. What ``CANDIDATE`` finds there itself is left to it.
ASSIGNED = (
    "(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|bearer)"
    "(?:[sS]?[0-9]{0,4}|[_-][A-Za-z0-9_-]{0,40}|[A-Z][A-Za-z0-9_]{0,40})(?![A-Za-z0-9])[\"']?\\]?\\s{0,8}"
    "(?::=|=>|==?|:)\\s{0,8}[\"'`]?"
    "(?!-----BEGIN [A-Z ]*PRIVATE KEY)"
    "(?!(?:(?<![\"'`])|(?=[^\"'`\\n]*(?:[\\n]|\\z)))"
    "(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}(?:[\\s\"'`,;]|[.)\\]}>]*(?:\\s|\\z)|\\z))"
    "(?!(?<=[\"'`])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}[\"'`])"
    "((?<=\")[^\"\\n]+(?=\")|(?<=')[^'\\n]+(?=')|(?<=`)[^`\\n]+(?=`)"
    "|[^\\s\"'`]*[^\\s\"'`,;.)\\]}>])"
)
#: Values that only stand for one.
STAND_IN = "(?i)^([$%<{(\\[].*|[*.#_-]+|none|null|nil|true|false|undefined|required|optional)$"
# Formats of issuers, and words that name a credential or something else.
ISSUED = (
    "^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
    "|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|-----BEGIN )"
)
CREDENTIAL = "(?i)(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|bearer)"
# Whole words only: "border" is no order and "latest" no test.
OTHER = (
    "(?i)(?<![a-z])(commit|revision|sha1|sha256|md5|checksum|digest|uuid|order|invoice|card|phone|iban)s?"
    "(?![a-z])"
)
SAMPLE = "(?i)(?<![a-z])(example|sample|dummy|placeholder|fake|changeme|x{4,}|test)s?(?![a-z])"
#: Candidates that are samples themselves: a sample word, or an ending of issuers' own samples.
KNOWN_SAMPLE = f"({SAMPLE}|EXAMPLE(KEY)?$)"

FEATURES = [
    "length", "digits", "upper", "lower", "marks", "distinct", "changes", "hexadecimal", "numeric",
    "issued", "transition", "coverage", "assigned", "quoted", "credential", "other", "sample",
    "sample_path", "known_sample", "joined", "bits",
]


def share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def strength() -> Column:
    """Bits of the candidate if its characters were chosen at random from the kinds it has."""
    kinds = {"[a-z]": 26, "[A-Z]": 26, "[0-9]": 10, "[^A-Za-z0-9]": 33}
    parts = [F.when(F.col("candidate").rlike(p), F.lit(n)).otherwise(0) for p, n in kinds.items()]
    signs = parts[0] + parts[1] + parts[2] + parts[3]
    return F.length("candidate") * F.log2(F.greatest(signs, F.lit(1)))


def flag(column, pattern: str) -> Column:
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False)).cast("double")


def findings(docs: DataFrame, key: str, text: str, path: str | None) -> DataFrame:
    """Every candidate of every whole text, with its offset in characters and its neighbours.

    ``row_key`` is the same for rows of equal key and text only.
    """
    doc_id, body = F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(place, F.lit("")).alias("path"),
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(1)).alias("all"),
        F.regexp_extract_all(body, F.lit(ASSIGNED), F.lit(1)).alias("values"),
    )
    name = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "path", "body")
    rows = rows.withColumn("row_key", F.md5(name))
    runs = rows.where(F.size("all") > 0).select(
        "doc_id",
        "path",
        "row_key",
        "all",
        F.col("all").alias("whole"),
        F.split("body", CANDIDATE, -1).alias("between"),
    )
    values = rows.where(F.size("values") > 0).select(
        "doc_id",
        "path",
        "row_key",
        F.col("values").alias("all"),
        F.regexp_extract_all("body", F.lit(ASSIGNED), F.lit(0)).alias("whole"),
        F.split("body", ASSIGNED, -1).alias("between"),
    )
    return placed(runs).unionByName(placed(values))


def placed(rows: DataFrame) -> DataFrame:
    """One row a candidate. ``whole`` are the matches, which end with the candidates ``all``, and
    ``between`` the text between them."""
    # The part of a match before its candidate belongs to the text before it.
    lead = F.zip_with(
        "whole", "all", lambda w, c: F.substring(w, F.lit(1), F.length(w) - F.length(c))
    )
    rows = rows.select(
        "doc_id",
        "path",
        "row_key",
        "all",
        F.zip_with("between", lead, lambda b, f: F.concat(b, F.coalesce(f, F.lit("")))).alias("between"),
        F.col("between").alias("behind"),
    )
    sizes = F.zip_with(
        "between", "all", lambda a, b: F.length(a) + F.coalesce(F.length(b), F.lit(0))
    )
    # Offsets by a running sum, the last entry first, so that each step reads one element.
    offsets = F.aggregate(
        F.slice("sizes", 1, F.greatest(F.size("sizes") - 1, F.lit(0))),
        F.array(F.lit(0).cast("long")),
        lambda seen, n: F.concat(F.array(F.get(seen, F.lit(0)) + n), seen),
    )
    rows = rows.withColumn("sizes", sizes).withColumn("starts", F.reverse(offsets))
    parts = F.transform(
        "all",
        lambda c, i: F.struct(
            c.alias("candidate"),
            (F.get("starts", i) + F.length(F.get("between", i))).alias("offset"),
            F.substring(F.get("between", i), -NEAR, NEAR).alias("before"),
            F.substring(F.get("behind", i + 1), 1, NEAR).alias("after"),
        ),
    )
    return rows.select("doc_id", "path", "row_key", F.explode_outer(parts).alias("c")).select(
        "doc_id", "path", "row_key", "c.*"
    )


def dictionary(docs: DataFrame, text: str) -> DataFrame:
    """``word, n``: words of letters that the corpus has often, counted over all whole texts."""
    counted = (
        docs.select(F.explode_outer(words(F.col(text).cast("string"))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.where((F.col("n") >= DICTIONARY_COUNT) & F.col("word").rlike("^[a-z]{2,30}$"))


def pairs(column: str) -> Column:
    """The pairs of neighbouring letters."""
    low = F.lower(F.col(column))
    return F.regexp_extract_all(low, F.lit("(?=([a-z][a-z]))"), F.lit(1))


def transitions(dictionary: DataFrame) -> DataFrame:
    """``pair, chance``: the log probability of a letter after another; 676 rows at most."""
    counted = (
        dictionary.select("n", F.explode_outer(pairs("word")).alias("pair"))
        .where(F.col("pair").isNotNull())
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .withColumn("first", F.substring("pair", 1, 1))
    )
    firsts = counted.groupBy("first").agg(F.sum("n").alias("total"))
    return counted.join(firsts, "first").select("pair", F.log(F.col("n") / F.col("total")).alias("chance"))


def described(found: DataFrame, known: DataFrame) -> DataFrame:
    """The findings with their features. ``known`` is the dictionary."""
    distinct = found.select("candidate").distinct()
    chances = F.broadcast(transitions(known))
    moves = (
        distinct.select("candidate", F.explode_outer(pairs("candidate")).alias("pair"))
        .join(chances, "pair", "left")
        .groupBy("candidate")
        .agg(F.avg(F.when(F.col("pair").isNotNull(), F.coalesce("chance", F.lit(UNSEEN)))).alias("transition"))
    )
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{2,30})"), F.lit(1))
    covered = (
        distinct.select("candidate", F.explode_outer(runs).alias("word"))
        .join(known.select("word", F.lit(True).alias("listed")), "word", "left")
        .groupBy("candidate")
        .agg(F.sum(F.when(F.col("listed"), F.length("word")).otherwise(0)).alias("letters"))
    )
    before = F.regexp_extract("before", "(\\S+\\s+){0,3}\\S*$", 0)
    rows = found.join(moves, "candidate", "left").join(covered, "candidate", "left")
    rows = rows.withColumn("left", before)
    return rows.select(
        *found.columns,
        F.least(F.length("candidate"), F.lit(200)).cast("double").alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"),
        share("[^0-9A-Za-z]").alias("marks"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("distinct"),
        share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])").alias("changes"),
        flag("candidate", "^([0-9a-f]+|[0-9A-F]+)$").alias("hexadecimal"),
        flag("candidate", "^[0-9]+$").alias("numeric"),
        flag("candidate", ISSUED).alias("issued"),
        F.coalesce("transition", F.lit(0.0)).alias("transition"),
        (F.coalesce("letters", F.lit(0)) / F.length("candidate")).alias("coverage"),
        flag("left", "[=:]>?\\s*[\"'`]?$").alias("assigned"),
        flag("left", "[\"'`]$").alias("quoted"),
        flag("left", CREDENTIAL).alias("credential"),
        flag("left", OTHER).alias("other"),
        F.greatest(flag("left", SAMPLE), flag("candidate", KNOWN_SAMPLE)).alias("sample"),
        flag("path", SAMPLE).alias("sample_path"),
        flag("candidate", KNOWN_SAMPLE).alias("known_sample"),
        F.greatest(flag("left", "[@./]$"), flag("after", "^[@.]\\S")).alias("joined"),
        F.least(strength(), F.lit(200.0)).alias("bits"),
    )


def by_rule() -> Column:
    """Labels where no person gave any: a known format, or assigned to the name of a credential.

    A sample word nearby rules out the latter only; a known format is a sample only by itself. Plain
    words of the dictionary, stand-ins such as ``${PASSWORD}`` and values of few bits are no secrets.
    """
    plain = F.col("candidate").rlike("^[A-Za-z]+$") & (F.col("coverage") >= 1)
    value = (F.col("numeric") == 0) & ~plain & ~F.col("candidate").rlike(STAND_IN)
    value &= F.col("bits") >= LEAST_BITS
    named = (F.col("credential") > 0) & (F.col("assigned") > 0) & value
    issued = (F.col("issued") > 0) & (F.col("known_sample") == 0)
    return (issued | (named & (F.col("other") == 0) & (F.col("sample") == 0))).cast("double")


def fit(labelled: DataFrame, label: str = "label", rows: int = TRAIN_ROWS) -> PipelineModel | None:
    """A random forest from findings with features and a label, at most ``rows`` of them.

    Findings without a label are left out. Without any there is no forest.
    """
    order = [F.xxhash64("candidate", "before", "after"), "row_key", "offset"]
    known = labelled.where(F.col(label).isNotNull())
    sample = stage(known.orderBy(*order).limit(rows).select(*FEATURES, label), "labelled-findings")
    if sample.agg(F.count_distinct(label).alias("n")).first().n == 0:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]
    path = scratch_path(labelled.sparkSession, "forest")
    Pipeline(stages=stages).fit(sample).write().save(path)
    # Read back without its training summary, which holds the session: once a query of the session
    # has been observed, that can't be sent to tasks.
    return PipelineModel.load(path)


def judge(rows: DataFrame, model: PipelineModel | None, label: str = "label") -> DataFrame:
    """Add ``score`` and ``is_secret``; without a forest all candidates count as secrets."""
    if model is None:
        return rows.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    chance = F.get(vector_to_array("probability"), F.lit(1))
    scored = model.transform(rows).withColumn("score", F.coalesce(chance, F.lit(0.0)))
    return scored.withColumn("is_secret", F.col("score") >= 0.5)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """Every candidate of every text: ``doc_id, row_key, offset, length, candidate, score, is_secret``.

    ``labelled`` are findings with the columns of ``described`` and a label 0 or 1; without them the
    labels follow ``by_rule``. ``path``, where given, names the column that tells samples and tests.
    Null and empty texts have no candidates, so no rows; a null key stays null; each occurrence in a
    repeated row is a row of its own. Other columns are not read. An empty table has no findings.
    Texts are read whole; a key block without its end is followed for 400 lines.
    """
    prepared = findings(docs, key, text, path)
    known = stage(dictionary(docs, text), "dictionary")
    rows = stage(described(stage(prepared, "candidates"), known), "described")
    rows = rows.withColumn("label", by_rule())
    model = fit(rows if labelled is None else labelled)
    return judge(rows.drop("label"), model).select(
        "doc_id",
        "row_key",
        "offset",
        F.length("candidate").cast("long").alias("n_chars"),
        "candidate",
        *[c for c in FEATURES if c not in ("length",)],
        "score",
        "is_secret",
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every found secret replaced by ``mask`` where it stands, and nowhere else;
    all other characters and all columns are kept as they were.

    A candidate of which the document has an equal one that is a secret is one too. Of findings that
    overlap, what they cover together is replaced once. Null texts stay null, empty
    ones empty; rows of an equal key and text are redacted alike; an empty table stays empty. Columns
    may have any names. Texts are read whole.
    """
    found = scan(docs, key, text).select("row_key", "offset", "n_chars", "candidate", "is_secret")
    same = Window.partitionBy("row_key", "candidate")
    found = found.distinct().withColumn("is_secret", F.max("is_secret").over(same))
    found = found.where("is_secret").select("row_key", "offset", "n_chars")
    order = Window.partitionBy("row_key").orderBy("offset", "n_chars")
    covered = F.max(F.col("offset") + F.col("n_chars")).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    # What lies between the text masked so far and a finding stays; within it there is nothing new.
    found = found.withColumn("done", F.coalesce(covered, F.lit(0).cast("long")))
    begins = F.col("offset") >= F.col("done")
    per_row = found.groupBy("row_key").agg(
        F.array_sort(F.collect_list(F.when(begins, F.struct("offset", "done")))).alias("spans"),
        F.max(F.col("offset") + F.col("n_chars")).alias("last"),
    )
    body, doc_id = F.col(named(text)).cast("string"), F.col(named(key)).cast("long")
    name = F.concat_ws(
        " ", F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(""), F.coalesce(body, F.lit(""))
    )
    rows = docs.select(packed(docs), body.alias("body"), F.md5(name).alias("row_key"))

    def kept(span):
        size = span["offset"] - span["done"]
        return F.concat(F.substring(F.col("body"), span["done"] + 1, size), F.lit(mask))

    tail = F.substring(F.col("body"), F.col("last") + 1, F.length("body"))
    masked = F.concat(F.array_join(F.transform("spans", kept), ""), tail)
    joined = rows.join(per_row, "row_key", "left")
    masked = F.when(F.col("spans").isNull(), F.col("doc").getField(text)).otherwise(masked)
    own = {c: F.col("doc").getField(c) for c in docs.columns} | {text: masked}
    return joined.select(*[column.alias(c) for c, column in own.items()])


def report(found: DataFrame) -> DataFrame:
    """Findings without the strings themselves."""
    return found.select(
        "doc_id",
        "offset",
        "n_chars",
        F.sha2("candidate", 256).alias("candidate_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )
