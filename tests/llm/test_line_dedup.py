from pyspark.sql import functions as F

from llm.helpers import documents, stored
from voltlake.llm.line_dedup import dedup_lines

ROWS = [
    (2, "p\nq\nr\ns\nx"), (1, "a\np\nq\nr\nb"), (3, "r\ns\nx\ny"), (4, "l\nl\nl\nl\nl"), (5, "p\nq"),
    (6, None), (7, ""), (8, "a\n\n\n\nb"), (9, "p\nq\nr"), (9, "p\nq\nr"), (None, "k\nk2\nk3"),
    (10, "k\nk2\nk3\n"), (11, "\n".join(f"n{i}" for i in range(3000)) + "\np\nq\nr"),
]


def plain(rows, width=3):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), []
    for k in order:
        i, text = rows[k]
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines, gone = text.split("\n"), set()
        for p in range(len(lines) - width + 1):
            window = tuple(lines[p : p + width])
            if window in seen:
                gone.update(range(p, p + width))
            seen.add(window)
        kept = [x for p, x in enumerate(lines) if p not in gone]
        out.append((i, "\n".join(kept), len(lines), len(gone)))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_equals_plain_python(spark, folder):
    docs = stored(spark, documents(spark, ROWS).withColumn("n_lines", F.lit("x")), folder("docs"))
    got = dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_removed"]
    rows = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(plain(ROWS), key=key)


def test_hot_window_and_empty_table(spark):
    rows = [(i, f"{i}\nsame\nsame2\nsame3\nend {i}") for i in range(300)]
    got = dedup_lines(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(i, 3 if i else 0) for i in range(300)]
    assert dedup_lines(documents(spark, [])).collect() == []
