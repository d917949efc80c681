"""Candidate secrets in texts, and a random forest that removes the false ones."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace

# Words that tell of credentials, and of samples.
CREDENTIAL_WORDS = "token|secret|passw|pwd|api_?key|auth|bearer|credential|private"
SAMPLE_WORDS = "test|example|sample|mock|dummy|fixture|docs?"

_BLANKS = r"[\x20\x09-\x0D]+"

# The value of a credential is a candidate, whatever its length and characters. Its key is a
# credential word with letters behind it, brackets or quotes that close, and = or :, maybe with
# a type or a scheme between them and the value.
# Of several credential words in one run of letters the last begins the key, so that each letter
# is read once, however often a text repeats such a word.
_WORD = rf"(?=[a-cpstA-CPST])(?i:{CREDENTIAL_WORDS})"
_KEY = (
    rf"{_WORD}(?:(?!{_WORD})[A-Za-z_\-])*+[0-9]{{0,4}}+[\"'`\])\\]{{0,4}}+[\x20\x09]*+"
    r"(?::[\x20\x09]*+[A-Za-z_][A-Za-z_.\[\]?]*+[\x20\x09]*+=(?!=)|[=:]{1,3}+>?)"
    rf"(?:{_BLANKS}(?=[\"'`])|[\x20\x09]*+)(?:(?i:bearer|basic)[\x20\x09]++)?\\?[\"'`]?"
    r"(?:(?<=[\"'`])(?i:bearer|basic)[\x20\x09]++)?"
)
# A run of these characters of at least this length, with a digit in it, is a candidate too.
CHARS = r"[A-Za-z0-9+/_=\-]"
SHORTEST = 16
_NO_DIGIT = r"[A-Za-z+/_=\-]"
_ANY_RUN = rf"(?<!{CHARS})(?={_NO_DIGIT}*+[0-9]){CHARS}{{{SHORTEST},}}+"


def _quoted(quote: str) -> str:
    """A value up to the quote that closes it; one with blanks and runs in it is no single value."""
    inside = rf"[^{quote}\r\n]"
    return (
        rf"(?<={quote}|{quote}(?i:bearer|basic)[\x20\x09])(?!{quote})"
        rf"(?!(?={inside}*?[\x20\x09]){inside}*?{_ANY_RUN})"
        rf"[^\r\n]+?(?<=[^\\]|\\\\)(?={quote})"
    )


_PLAIN = r"[^\x20\x09-\x0D\"'`,;&<>{}()\[\]\\][^\x20\x09-\x0D\"'`,;&<>{}]*(?<![)\]\\])"
_ESCAPED = r"(?<=\\[\"'])[^\"'\\\r\n]++(?=\\[\"'])"
_VALUE = "|".join([_ESCAPED, *map(_quoted, "\"'`"), _PLAIN])
# A run ends before a key and its value, and is tried at its start only: long runs cost one pass.
_NO_KEY = rf"(?!{_KEY}(?:{_VALUE}))"
_RUN = rf"(?<!{CHARS})(?={CHARS}{{{SHORTEST}}})(?=(?:{_NO_KEY}{_NO_DIGIT})*+{_NO_KEY}[0-9])(?:{_NO_KEY}{CHARS}){{{SHORTEST},}}+"
# Groups: the key, its value, the run.
_CANDIDATE = rf"({_KEY})({_VALUE})|({_RUN})"
# Marks set around candidates; a text's own such characters are taken for the spare one.
_START, _END, _SPARE = "\x01", "\x02", "\x03"

DICTIONARY_SIZE = 1000
# The forest is fitted on at most so many labelled findings.
TRAINING_FINDINGS = 50_000
TREES, DEPTH = 30, 8
HASHED_FEATURES = 64
THRESHOLD = 0.5

_TRANSITIONS = {
    "letter_digit": r"(?<=[A-Za-z])(?=[0-9])",
    "digit_letter": r"(?<=[0-9])(?=[A-Za-z])",
    "lower_upper": r"(?<=[a-z])(?=[A-Z])",
    "upper_lower": r"(?<=[A-Z])(?=[a-z])",
    "repeated": r"(.)(?=\1)",
    "digit_digit": r"(?<=[0-9])(?=[0-9])",
    "other": r"[+/_=\-]",
}


def find_candidates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """``id``, ``path``, ``word`` (place of the word), ``nth`` (in the word), ``candidate`` and its
    neighbours: three words before and one after, ``left`` and ``right`` (what stands between it
    and the next candidate, or the end, of its word on each side) and both together as ``around``.

    Candidates are the values of credentials, of any length and characters, and runs of at least
    ``SHORTEST`` characters with a digit. Words are separated by ASCII white space. A null text
    has no candidates; a null path or a missing neighbour is empty. Neighbours are whole, up to the nearest candidate that
    they hold. The words before belong to a word's first candidate, the one after to its last:
    for the others another candidate is nearer.
    """
    text = docs[text_col]
    path = docs[path_col].cast("string") if path_col else F.lit("")
    marked = F.regexp_replace(
        F.translate(text, _START + _END, _SPARE * 2), _CANDIDATE, f"$1{_START}$2$3{_END}"
    )
    rows = docs.filter(text.rlike(_CANDIDATE)).select(
        docs[id_col].alias("id"),
        F.coalesce(path, F.lit("")).alias("path"),
        *(F.regexp_extract_all(text, F.lit(_CANDIDATE), F.lit(k)).alias(f"_group{k}") for k in (1, 2, 3)),
        F.split(text, _CANDIDATE).alias("_between"),
        F.split(marked, _BLANKS).alias("_words"),
    )
    # A key belongs to what stands before its value; nothing follows the last part.
    keys = F.concat("_group1", F.array(F.lit("")))
    rows = rows.select(
        "id",
        "path",
        "_words",
        F.zip_with("_group2", "_group3", lambda value, run: F.concat(value, run)).alias("_found"),
        F.zip_with("_between", keys, lambda between, key: F.concat(between, key)).alias("_gaps"),
    )

    def counted(word: Column, place: Column) -> Column:
        n = F.when(F.contains(word, F.lit(_START)), F.regexp_count(word, F.lit(_START))).otherwise(0)
        return F.struct(place.alias("word"), n.alias("n"))

    def numbered(word: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), word["n"] - 1),
            lambda nth: F.struct(word["word"].alias("word"), nth.alias("nth"), word["n"].alias("n")),
        )

    def neighbour(place: Column, side: str) -> Column:
        # A negative place would count from the end.
        found = F.coalesce(F.when(place >= 0, F.get("_words", place)), F.lit(""))
        nearest = F.substring_index(found, _END, -1) if side == "before" else F.substring_index(found, _START, 1)
        return F.lower(F.translate(nearest, _START + _END, ""))

    def with_neighbours(c: Column) -> Column:
        at, first = c["at"], c["at"]["nth"] == 0
        left = F.lower(F.element_at(F.split(c["left"], _BLANKS), -1))
        right = F.lower(F.element_at(F.split(c["right"], _BLANKS), 1))
        before = [
            F.when(first, neighbour(at["word"] - k, "before")).otherwise("").alias(f"before{k}")
            for k in (3, 2, 1)
        ]
        # A quoted value may hold blanks and end in a later word.
        last = at["word"] + F.regexp_count(c["candidate"], F.lit(_BLANKS))
        after = F.when(at["nth"] == at["n"] - 1, neighbour(last + 1, "after")).otherwise("")
        return F.struct(
            at["word"].alias("word"),
            *before,
            after.alias("after1"),
            left.alias("left"),
            right.alias("right"),
            F.concat(left, right).alias("around"),
            at["nth"].alias("nth"),
            c["candidate"].alias("candidate"),
        )

    places = F.flatten(
        F.transform(F.filter(F.transform("_words", counted), lambda w: w["n"] > 0), numbered)
    )
    n = F.size("_gaps") - 1
    parts = F.arrays_zip(
        places.alias("at"),
        F.col("_found").alias("candidate"),
        F.slice("_gaps", 1, n).alias("left"),
        F.slice("_gaps", 2, n).alias("right"),
    )
    return rows.select("id", "path", F.inline(F.transform(parts, with_neighbours)))


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_SIZE) -> list[str]:
    """The ``size`` most frequent words of three to eight letters in all texts, ties by the alphabet."""
    words = docs.select(F.explode(F.split(F.lower(docs[text_col]), _BLANKS)).alias("w"))
    counted = words.filter(F.col("w").rlike("^[a-z]{3,8}$")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in counted.orderBy(F.desc("n"), "w").limit(size).collect()]


def with_features(candidates: DataFrame, dictionary: list[str]) -> DataFrame:
    """``candidates`` with the column ``features`` for the forest."""
    candidate, length = F.col("candidate"), F.length("candidate")
    numbers = {"length": length.cast("double")}
    for name, pattern in _TRANSITIONS.items():
        numbers[name] = F.regexp_count(candidate, F.lit(pattern)) / length
    # Longer words first, so that a word is not covered by its beginning only.
    pattern = "|".join(sorted(dictionary, key=lambda w: (-len(w), w))) or r"(?!)"
    rest = F.regexp_replace(F.lower(candidate), F.lit(pattern), F.lit(""))
    numbers["covered"] = 1 - F.length(rest) / length
    numbers["path_depth"] = F.size(F.split("path", "/")).cast("double")
    numbers["path_sample"] = F.lower("path").rlike(SAMPLE_WORDS).cast("double")
    # What stands after a candidate may be the key of another one.
    near = F.concat_ws(" ", "before3", "before2", "before1", "left")
    numbers["near_credential"] = near.rlike(CREDENTIAL_WORDS).cast("double")
    numbers["near_sample"] = (near.rlike(SAMPLE_WORDS) | F.col("right").rlike(SAMPLE_WORDS)).cast("double")
    numbers["assigned"] = (
        F.col("before1").rlike("[=:]$") | F.col("left").rlike("[=:]")
    ).cast("double")
    numbers["quoted"] = F.col("around").rlike("[\"'`]").cast("double")
    frame = candidates.select("*", *(v.alias(f"_{k}") for k, v in numbers.items()))
    hashed = FeatureHasher(
        inputCols=["before2", "before1", "after1", "path"],
        outputCol="_neighbours",
        numFeatures=HASHED_FEATURES,
    ).transform(frame)
    assembler = VectorAssembler(
        inputCols=[*(f"_{k}" for k in numbers), "_neighbours"], outputCol="features", handleInvalid="keep"
    )
    return assembler.transform(hashed).select(*candidates.columns, "features")


def score_findings(
    candidates: DataFrame, labelled: DataFrame, dictionary: list[str], limit: int = TRAINING_FINDINGS
) -> DataFrame:
    """``candidates`` with ``probability`` of being a secret.

    ``labelled`` are candidates with ``label`` (1 or 0; null ones are passed over). The forest
    learns from at most ``limit`` of them, those with the smallest hashes. If they are
    all of one kind, every candidate gets that kind; without any, 1.0: nothing is
    removed unlearned.
    """
    order = F.xxhash64("id", "word", "nth", "candidate")
    sample = labelled.filter("label is not null").orderBy(order, "id", "word", "nth").limit(limit)
    sample = Workspace(candidates.sparkSession).save(sample, "labelled-findings")
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        only = float(kinds[0]) if kinds else 1.0
        return candidates.withColumn("probability", F.lit(only))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=1
    )
    ready = with_features(sample, dictionary).withColumn("label", F.col("label").cast("double"))
    model = forest.fit(ready.select("features", "label"))
    scored = model.transform(with_features(candidates, dictionary))
    return scored.select(
        *candidates.columns, F.element_at(vector_to_array("probability"), 2).alias("probability")
    )


def rule_label() -> Column:
    """1 for a candidate that is the quoted or plain value of a credential, 0 for any other."""
    near = F.concat_ws(" ", "before2", "before1", "left")
    return (near.rlike(rf"({CREDENTIAL_WORDS})[a-z_\"']*!* *[=:]")).cast("int")


def scan_secrets(
    docs: DataFrame,
    reviewed: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = THRESHOLD,
    label: Column | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per candidate of ``docs``: id, ``word``, ``nth``, ``candidate``, ``probability``, ``is_secret``.

    The findings in documents whose id is in ``reviewed`` are the labelled ones; ``label``
    tells their labels, by default a rule on the credential words before them. The
    dictionary is counted over all documents. Repeated rows give repeated findings; a
    null id is scanned but never reviewed. Without documents there are no findings.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    candidates = workspace.save(find_candidates(docs, id_col, text_col, path_col), "candidates")
    dictionary = frequent_words(docs, text_col)
    known = reviewed.select(reviewed[id_col].alias("id")).distinct()
    labelled = candidates.join(known, "id", "left_semi").withColumn(
        "label", rule_label() if label is None else label
    )
    scored = score_findings(candidates, labelled, dictionary)
    return scored.select(
        F.col("id").alias(id_col),
        F.col("word").cast("long").alias("word"),
        F.col("nth").cast("long").alias("nth"),
        "candidate",
        "probability",
        (F.col("probability") >= threshold).alias("is_secret"),
    )
