"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a long run of key-like characters with a digit, the whole value behind a key word and
`=` or `:`, or the password of `name:password@host`, of any length and alphabet. The forest is trained
on labelled findings and sees the candidate's length, character transitions, dictionary coverage, the
path it stands in and the words beside it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdex.llm.common import pinned, small, stored

#: At least 12 key characters in a row, one of them a digit.
_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
_KEY_WORD = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|key|auth|credentials?|bearer)"
#: The non-blank value behind a key word, with or without quotes; the first look behind is only faster.
_ASSIGNED = rf"(?<=[=:\s\"'`])(?<={_KEY_WORD}[\"'`]?\s{{0,2}}[=:]\s{{0,2}}[\"'`]?)[^\s\"'`=:][^\s\"'`]*+"
#: What stands between a name with a colon and a host.
_LOGIN = r"(?<=[A-Za-z0-9_.-]:)(?<!mailto:)[^\s/@:]++(?=@[A-Za-z0-9])"
CANDIDATE = f"{_ASSIGNED}|{_LOGIN}|{_RUN}"
#: Characters on each side that the features of a candidate see.
CONTEXT = 60
#: Most frequent words of the corpus that make up the dictionary.
DICTIONARY = 3000
#: Labelled findings that the forest is fitted on at most, half of them from each label, those with
#: the smallest hash.
TRAIN_FINDINGS = 4000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
MASK = "[SECRET]"
#: Characters from which a secret is masked wherever it occurs in its text.
LONG = 12
#: Documents with secrets up to which they are broadcast when texts are masked.
BROADCAST_DOCS = 20_000

_WORDS_BEFORE = r"(?i)(pass|pwd|secret|token|api|key|auth|credential|bearer|private)[^\s]{0,12}(\s+\S{1,4})?\s*\S{0,4}$"
FEATURES = (
    "length", "digits", "upper", "lower", "transitions", "distinct", "hex", "numeric", "covered", "slashes", "in_path",
    "keyword", "assigned", "quoted", "ends_line",
)
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The `size` words of at least three letters that most rows of `docs` (text) have, ties by word."""
    words = F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))
    counts = docs.select(F.explode(words).alias("word")).where(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r.word for r in counts.orderBy(F.col("n").desc(), "word").limit(size).collect()]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, number (of the candidate in its text, from 0), candidate, before and after (context).

    Null texts and texts without candidates give no rows.
    """
    found, between = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)), F.split("text", CANDIDATE)
    rows = pinned(docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE)), found=found, between=between)
    return (
        rows.select("doc_id", "between", F.posexplode("found").alias("number", "candidate"))
        .select(
            "doc_id", "number", "candidate", F.right(F.get("between", F.col("number")), F.lit(CONTEXT)).alias("before"),
            F.left(F.get("between", F.col("number") + 1), F.lit(CONTEXT)).alias("after"),
        )
    )


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Add the forest's numeric features to candidates (candidate, before, after)."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.length(F.regexp_replace(c, pattern, "")) / n
    classes = F.translate(F.translate(F.translate(c, _LOWER, "a" * 26), _UPPER, "A" * 26), "0123456789+/_-=", "0" * 10 + "-" * 5)
    runs = F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0)), lambda x: F.array_contains(F.lit(words), x)) \
        if words else F.array().cast("array<string>")
    flag = lambda x: x.cast("double")
    return pinned(
        found,
        length=n.cast("double"), digits=share("[^0-9]"), upper=share("[^A-Z]"), lower=share("[^a-z]"),
        transitions=(F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n,
        distinct=F.size(F.array_distinct(F.split(c, ""))) / n,
        hex=flag(c.rlike("^[0-9a-f]+$") | c.rlike("^[0-9A-F]+$")), numeric=flag(c.rlike("^[0-9-]+$")),
        covered=F.aggregate(runs, F.lit(0), lambda a, x: a + F.length(x)) / n,
        slashes=F.length(F.regexp_replace(c, "[^/]", "")).cast("double"),
        in_path=flag(F.col("before").rlike(r"(://|[/\\~.])\S*$") | F.col("after").rlike(r"^\.[a-z]{1,4}\b")),
        keyword=flag(F.col("before").rlike(_WORDS_BEFORE)), assigned=flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        quoted=flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        ends_line=flag(F.col("after").rlike("^(\n|$)")),
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by fixed formats, for corpora without hand-labelled ones.

    `label` is 1 for an issuer's format, and for a value of eight characters or more with letters and
    digits assigned to a key word; 0 for a number, a path, or a run with neither. Other values behind a
    key word or a name (words, short ones, letters only) have no label: the forest alone judges them.
    """
    c = F.col("candidate")
    issuer = c.rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abp]-.*|AIza[0-9A-Za-z_-]{35})$")
    given = F.col("before").rlike(_WORDS_BEFORE) & F.col("before").rlike(r"[=:]\s*[\"'`]?$")
    mixed = (F.length(c) >= 8) & c.rlike("[A-Za-z]") & c.rlike("[0-9]")
    run = c.rlike(f"^(?:{_RUN})$")
    return found.withColumn("label", F.when(c.rlike("^[0-9-]+$") & run, 0).when(issuer | (given & mixed), 1).when(~given & run, 0))


def judge(found: DataFrame, findings: DataFrame, words: list[str], train_findings: int = TRAIN_FINDINGS) -> DataFrame:
    """Add `probability` to candidates, by a forest fitted on labelled `findings`.

    `findings`: candidate, before, after, label (1 secret, 0 false positive; other rows are ignored).
    At most half of `train_findings` are used from each label, distinct ones with the smallest hash, in
    one partition and one order, so that the forest does not depend on how they are dealt. The labels
    weigh the same, so the verdict does not turn with the share of secrets. If all findings lack a
    label nothing is known of false positives, and every candidate has probability 1.
    """
    rows = findings.where(F.col("label").isin(0, 1)).select("candidate", "before", "after", F.col("label").cast("double")).distinct()
    at = F.xxhash64("candidate", "before", "after", "label")
    order = [at, "candidate", "before", "after", "label"]
    negative, positive = (rows.where(F.col("label") == x).orderBy(*order).limit(max(1, train_findings // 2)) for x in (0, 1))
    sample = with_features(negative.unionByName(positive), words)
    sample = stored(sample.orderBy(*order).coalesce(1), "findings")
    counts = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if set(counts) != {0.0, 1.0}:
        return found.withColumn("probability", F.lit(1.0))
    weight = F.when(F.col("label") == 1, sum(counts.values()) / (2 * counts[1.0])).otherwise(sum(counts.values()) / (2 * counts[0.0]))
    sample = sample.withColumn("_weight", weight)
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", weightCol="_weight", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=1.0,
    ).fit(assemble.transform(sample))
    scored = forest.transform(assemble.transform(with_features(found, words)))
    return scored.select(*found.columns, vector_to_array("_probability")[1].alias("probability"))


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """All candidates of `docs` (doc_id, text) with the forest's verdict.

    Columns: doc_id, number, candidate, before, after, probability, is_secret. Without `findings` the
    forest is trained on the candidates themselves, labelled by fixed formats.

    Null and empty texts have no candidates; texts of any length are scanned whole; repeated rows are
    scanned each; null ids stay null; an empty table gives an empty result; other columns are ignored.
    """
    words = dictionary(docs.select("text"))
    found = stored(candidates(docs), "candidates")
    judged = judge(found, weak_labels(found) if findings is None else findings, words)
    return judged.withColumn("is_secret", F.col("probability") >= threshold)


def mask(text: Column, secrets: Column) -> Column:
    """`text` with the candidates that the array `secrets` holds masked where they stand.

    Secrets of `LONG` characters or more are then masked wherever else they occur, longest first; a
    shorter one may be a part of ordinary words and is masked as a candidate only.
    """
    found, between = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE)
    told = F.transform(found, lambda c: F.when(F.array_contains(secrets, c), F.lit(MASK)).otherwise(c))
    whole = F.array_join(F.flatten(F.zip_with(between, told, lambda t, c: F.array(t, F.coalesce(c, F.lit(""))))), "")
    longest = F.array_sort(F.filter(secrets, lambda s: F.length(s) >= LONG), lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(longest, whole, lambda t, s: F.replace(t, s, F.lit(MASK)))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with the secrets of `found` (doc_id, candidate, is_secret) masked in `text`.

    All rows and columns of `docs` stay. Rows with one doc_id share their secrets; a null id matches
    null ids.
    """
    secrets = found.where("is_secret").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("candidate").alias("_secrets"))
    secrets = stored(secrets, "secrets")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))
    met = rows.join(small(secrets, BROADCAST_DOCS), F.col("_doc.doc_id").eqNullSafe(F.col("_id")), "left")
    text = F.when(F.col("_secrets").isNull(), F.col("_doc.text")).otherwise(mask(F.col("_doc.text"), F.col("_secrets")))
    return met.select(*[text.alias(c) if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])
