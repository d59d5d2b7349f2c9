"""Secret scanning: patterns propose findings, a random forest trained on labelled findings removes false positives.

Everything is DataFrame functions and the DataFrame API of Spark's own random forest; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.texts import row_key
from vigilake.session import staged

# A finding is a run of key-like characters with a digit somewhere, long enough to carry a secret, or any value that is
# assigned to a secret's name.
NAMES = r"pass(?:word|wd)?|pwd|token|secret|api[_-]?key|access[_-]?key|credential|bearer|auth"
CANDIDATE = (r"(?=[A-Za-z_\-.+/=@]{0,63}[0-9])[A-Za-z0-9_\-.+/=@]{12,}"
             r"|(?<=[=:]\s{0,2}[\"']?)(?<=(?i:(?<![a-z0-9])(?:" + NAMES + r")[\"']?\s{0,2}[=:]\s{0,2}[\"']?))[A-Za-z0-9_\-.+/=@!#$%&*^~?]+")
TRAINING_FINDINGS = 20_000   # labelled findings at most that the forest is fitted on
DICTIONARY_COUNT = 3         # a word of the dictionary behind the coverage feature occurs so often
TREES, DEPTH, SEED = 40, 8, 13
THRESHOLD = 0.5
REDACTED = "[SECRET]"
KEY_LIKE = 12                # shorter values are replaced only where they stand alone
NEIGHBOUR = r"(?i)\b(" + NAMES + r")\b"
# placeholder words count inside the value and directly in front of it, as whole words
SAMPLE_IN = r"(?i)(?<![a-z0-9])(example|sample|dummy|test|fake|placeholder|changeme)(?![a-z0-9])|(?<![a-z0-9])your[_-]|xxxx"
SAMPLE_FRONT = r"(?i)(?<![a-z0-9@._/\-])(example|sample|dummy|test|fake|placeholder)[\s=:\"'(]{1,4}$|[=:]\s{0,2}[\"']?<$"

FEATURES = ["chars", "digit_share", "upper_share", "lower_share", "symbol_share", "changes", "letter_digit", "vowel_share",
            "repeats", "distinct_share", "coverage", "path", "address", "assigned", "quoted", "key_word_near",
            "sample_word_near", "hex_only", "digits_only"]


def findings(docs: DataFrame) -> DataFrame:
    """One row per finding: doc_id, at (from 0), finding, before (the 40 characters in front), after (the next 20).

    ``docs``: doc_id bigint, text string; further columns are ignored. Null or empty texts give no rows.
    """
    text = F.col("text").cast("string")
    found = docs.select("doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"))
    # the texts between findings give their places; only documents with findings are split
    cut = found.filter(F.size("found") > 0).withColumn("gaps", F.split("text", CANDIDATE, -1))
    step = F.arrays_zip(F.transform("gaps", F.length).alias("gap"), F.transform("found", F.length).alias("own"))
    ends = F.aggregate(
        F.slice(step, F.lit(1), F.size("found")),
        F.struct(F.lit(0).alias("end"), F.expr("cast(array() as array<int>)").alias("starts")),
        lambda acc, s: F.struct((acc["end"] + s["gap"] + s["own"]).alias("end"),
                                F.concat(acc["starts"], F.array(acc["end"] + s["gap"])).alias("starts")),
        lambda acc: acc["starts"])
    rows = cut.withColumn("starts", ends).select(
        "doc_id", "text", F.explode(F.arrays_zip("starts", "found")).alias("f"))
    at, finding = F.col("f.starts"), F.col("f.found")
    lead = F.least(at, F.lit(40))
    return rows.select(
        "doc_id", at.alias("at"), finding.alias("finding"),
        F.substring("text", at - lead + 1, lead).alias("before"),
        F.substring("text", at + F.length(finding) + 1, F.lit(20)).alias("after"))


def dictionary(docs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(word): whole words of three letters or more that occur DICTIONARY_COUNT times in all documents together.

    ``wanted`` (word): only these are returned. Words are counted before they meet ``wanted``: tasks add up their own
    occurrences first, so what is shuffled and joined follows the number of different words, not of occurrences.
    """
    whole = r"(?<![\p{L}\p{N}_])\p{L}{3,}(?![\p{L}\p{N}_])"
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(whole), F.lit(0))).alias("word"))
    known = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= DICTIONARY_COUNT).select("word")
    return known if wanted is None else known.join(wanted.distinct(), "word")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add the columns FEATURES to findings."""
    value, size = F.col("finding"), F.length("finding")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    near = F.concat_ws(" ", "before", "finding")
    plain = found.withColumns({
        "chars": size.cast("double"),
        "digit_share": share("[0-9]"), "upper_share": share("[A-Z]"), "lower_share": share("[a-z]"),
        "symbol_share": share("[^A-Za-z0-9]"),
        "changes": share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
        "letter_digit": share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "vowel_share": share("[aeiouAEIOU]"),
        "repeats": share(r"(.)\1"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / size,
        "path": value.rlike(r"/[^/]*/|\.(com|org|net|html?|png|jpg|py|js)\b").cast("double"),
        "address": value.rlike(r"@|^\d{1,3}(\.\d{1,3}){3}$").cast("double"),
        "assigned": (F.col("before").rlike(r"[=:]\s*[\"']?$") | value.rlike(r"^[A-Za-z_]+=[^=]")).cast("double"),
        "quoted": F.col("before").rlike(r"[\"']$").cast("double"),
        "key_word_near": near.rlike(NEIGHBOUR).cast("double"),
        "sample_word_near": (value.rlike(SAMPLE_IN) | F.col("before").rlike(SAMPLE_FRONT)).cast("double"),
        "hex_only": value.rlike(r"^([A-Za-z_]+=)?[0-9a-fA-F]{12,}$").cast("double"),
        "digits_only": value.rlike(r"^[0-9 .+\-]+$").cast("double"),
    })
    # dictionary coverage: letters of the finding inside words of the dictionary, over all its characters
    covered = _runs(found).join(words, "word").groupBy("finding").agg(F.sum(F.length("word")).alias("inside"))
    return plain.join(covered, "finding", "left").withColumn("coverage", F.coalesce(F.col("inside") / size, F.lit(0.0))).drop("inside")


def _runs(found: DataFrame) -> DataFrame:
    """(finding, word): the runs of three letters or more inside each different finding."""
    return found.select("finding").distinct().select(
        "finding", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))


def rule_label(finding: str = "finding", before: str = "before") -> Column:
    """Label of a finding whose kind is certain: 1 for issued key formats and random values assigned to a secret's name,
    0 for addresses, numbers, plain words and placeholders, null where the form doesn't tell.

    Stands in for reviewed findings where a corpus has none; ``fit`` takes any labelled findings.
    """
    value, near = F.col(finding), F.concat_ws(" ", before, finding)
    named = near.rlike(NEIGHBOUR) & (F.col(before).rlike(r"[=:]\s*[\"']?$") | value.rlike("="))
    issued = value.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[bp]-|^sk_live_[A-Za-z0-9]{16,}$|^eyJ[\w-]+\.eyJ")
    harmless = value.rlike(r"@.*\.|^[0-9.+\-/]+$|^\d{1,3}(\.\d{1,3}){3}|^(https?:)?/?/|^[A-Za-z]+\d{0,2}$") | value.rlike(SAMPLE_IN)
    random = value.rlike(r"[0-9a-fA-F]{16,}$|[A-Za-z0-9+/_\-]{24,}={0,2}$")
    # an issued format is certain by itself; words in front of a value decide only where its own form doesn't
    return F.when(issued, F.lit(1)).when(harmless, F.lit(0)).when(named & random, F.lit(1)).when(
        F.col(before).rlike(SAMPLE_FRONT), F.lit(0)).cast("double")


def fit(labelled: DataFrame, most: int = TRAINING_FINDINGS) -> RandomForestClassificationModel | None:
    """Forest on findings with FEATURES and a ``label`` (0 or 1; null labels don't count); None when one class is missing.

    At most ``most`` findings per class, those with the smallest hash, so every run fits the same forest.
    """
    known = labelled.filter("label is not null").select("label", *FEATURES, F.xxhash64("doc_id", "at", "finding").alias("h"))
    part = lambda label: known.filter(F.col("label") == label).orderBy("h", *FEATURES).limit(most)
    sample = staged(part(1.0).unionByName(part(0.0)), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return forest.fit(assembled.select("label", "features"))


def score(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``is_secret``; without a model every finding stays a secret."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("is_secret", F.col("score") >= threshold).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, at, finding, before, after, score, is_secret) for every finding of ``docs``.

    ``labelled``: findings with ``label``, ``finding``, ``before``, ``doc_id`` and ``at``; without it, findings of the
    documents themselves whose form is certain are the labels. Null texts give no findings; rows with null or repeated
    ids each give theirs; an empty table gives none; further columns are ignored.
    """
    proposed = staged(findings(docs), "proposed")
    inside = _runs(proposed if labelled is None else proposed.select("finding").unionByName(labelled.select("finding")))
    words = staged(dictionary(docs, inside.select("word")), "dictionary")
    found = staged(with_features(proposed, words), "findings")
    if labelled is None:
        marked = found.withColumn("label", rule_label())
    else:
        marked = with_features(labelled, words)
    model = fit(marked)
    return score(found, model).select("doc_id", "at", "finding", "before", "after", "score", "is_secret")


def redact(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """``docs`` with every found secret replaced by REDACTED; all rows and columns stay, n_chars follows the text.

    ``scanned`` is the scan of ``texts.keyed(docs)``. Only values that were judged secrets are replaced, at every place in
    the documents with that key; short ones where they stand alone.
    """
    values = scanned.filter("is_secret").groupBy(F.col("doc_id").alias("__key")).agg(F.collect_set("finding").alias("__secrets"))
    joined = docs.withColumn("__key", row_key()).join(values, "__key", "left")
    longest_first = F.array_sort("__secrets", lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1)
                                 .when(a < b, -1).when(a > b, 1).otherwise(0))
    # values hold no backslash, so they can be quoted; a short one may also be part of other words
    alone = lambda value: F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), value, F.lit(r"\E(?![A-Za-z0-9_])"))
    clean = F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(
        F.aggregate(longest_first, F.col("text"), lambda text, value: F.when(
            F.length(value) < KEY_LIKE, F.regexp_replace(text, alone(value), F.lit(REDACTED))).otherwise(
            F.replace(text, value, F.lit(REDACTED)))))
    out = joined.withColumn("__clean", clean)
    changes = {"text": F.col("__clean")}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.col("__secrets").isNull(), F.col("n_chars")).otherwise(
            F.length("__clean").cast(dict(docs.dtypes)["n_chars"]))
    return out.withColumns(changes).select(*docs.columns)
