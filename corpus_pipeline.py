"""A corpus pipeline: language, copies, near copies, benchmark passages, piece ids.

Each stage takes all rows that the stage before it kept and returns the columns it
was given; only the last returns ids in place of the text. Columns are renamed while
an operator works, so names like its results' do no harm. Null texts and empty
ones have no language and go in the first stage. Rows that repeat an id are told
apart by where they are stored.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltlake.llm.addresses import FILE, ROW, addressed, stored_rows
from voltlake.llm.decontaminate import find_benchmark
from voltlake.llm.driver import release_driver
from voltlake.llm.exact_dedup import exact_dedup
from voltlake.llm.language_id import UNKNOWN, held_out, predict, train
from voltlake.llm.ngram_join import join_ngrams
from voltlake.llm.sentence_pieces import MODEL_PATH, encode_pieces
from voltlake.workspace import Workspace

# A document goes if no language is at least this likely.
LEAST_SCORE = 0.5


def _shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed to what no operator uses, and the new names."""
    names = {c: f"doc_column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(new).alias(old) for old, new in names.items()))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose most likely language is unlikely, go."""
    release_driver(spark)
    rows, names = _shielded(docs)
    columns = [names[c] for c in ("doc_id", "text", "lang")]
    doc_id = rows[columns[0]]
    model = train(rows.filter(doc_id.isNotNull() & ~held_out(doc_id)), *columns)
    release_driver(spark)
    judged = predict(rows, model, columns[1])
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _restored(judged.filter(known), names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, that with the smallest id stays."""
    release_driver(spark)
    workspace = Workspace(spark)
    rows, names = _shielded(docs)
    rows = stored_rows(rows, workspace)
    at = addressed(rows, workspace)
    judged = exact_dedup(rows, names["doc_id"], names["text"], addresses=True, workspace=workspace)
    kept = judged.filter("kept").select(FILE, ROW)
    return _restored(at.join(kept, [FILE, ROW], "left_semi"), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, that with the smallest id stays."""
    release_driver(spark)
    workspace = Workspace(spark)
    rows, names = _shielded(docs)
    rows = stored_rows(rows, workspace)
    at = addressed(rows, workspace)
    grouped = join_ngrams(rows, names["doc_id"], names["text"], addresses=True, workspace=workspace)
    doc_id = F.col(names["doc_id"])
    first = F.min(F.struct(doc_id.isNull().alias("last"), doc_id, FILE, ROW)).alias("first")
    kept = (
        grouped.filter("group is not null").groupBy("group").agg(first).select("first.*").select(FILE, ROW)
    ).unionByName(grouped.filter("group is null").select(FILE, ROW))
    return _restored(at.join(kept, [FILE, ROW], "left_semi"), names)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    release_driver(spark)
    workspace = Workspace(spark)
    rows, names = _shielded(docs)
    rows = stored_rows(rows, workspace)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = find_benchmark(rows, items, names["text"], workspace=workspace).select(FILE, ROW)
    return _restored(addressed(rows, workspace).join(gone, [FILE, ROW], "left_anti"), names)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the text: ``ids``, ``n_ids`` and ``round_trip`` beside all other columns."""
    release_driver(spark)
    others = [c for c in docs.columns if c != "text"]
    return encode_pieces(docs, MODEL_PATH, keep=others)


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding and decoding", encode_texts),
]

# Neither a trained classifier nor a Viterbi search can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
