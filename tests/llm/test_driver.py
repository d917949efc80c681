from llm.helpers import documents, stored
from voltlake.llm.driver import release_driver
from voltlake.llm.ngram_join import join_ngrams


def management(spark):
    return spark.sparkContext._jvm.java.lang.management.ManagementFactory


def full_collections(spark):
    """How often the driver's JVM has collected its whole heap."""
    beans = management(spark).getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_driver_gives_its_memory_back(spark):
    context = spark.sparkContext
    committed = lambda: management(spark).getMemoryMXBean().getHeapMemoryUsage().getCommitted()
    arrays = [context._gateway.new_array(context._jvm.byte, 64 << 20) for _ in range(8)]
    grown = committed()
    del arrays
    release_driver(spark)
    assert committed() < grown


def test_join_gives_memory_back_between_its_phases(spark, folder):
    # One token in many classes, so that pivots are tried before the pairs left are compared.
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(30)] + [(99, "a text of its own")]
    docs = stored(spark, documents(spark, rows), folder("docs"))
    before = full_collections(spark)
    found = {r["doc_id"]: r["component_id"] for r in join_ngrams(docs).collect()}
    assert found == {**dict.fromkeys(range(30), 0), 99: 99}
    # After each pass, each round of links and components, and before the result is read.
    assert full_collections(spark) - before >= 6
