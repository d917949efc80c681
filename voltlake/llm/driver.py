"""Memory that the driver holds without need, given back between the phases of a long job."""

import gc

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from .wordhash import release_memory

_TRIM = "systemTrimNativeHeap"


def _trim_native_heap(spark: SparkSession) -> bool:
    """``malloc_trim`` in the driver's JVM, by its own diagnostic command; says whether the JVM has it."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    java_class = jvm.java.lang.Class.forName
    try:
        command = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        # The server's class is hidden in its module; the interface is not.
        types = new_array(jvm.java.lang.Class, 4)
        names = "javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"
        for i, name in enumerate(names):
            types[i] = java_class(name)
        invoke = java_class("javax.management.MBeanServer").getMethod("invoke", types)
        given = new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = command, _TRIM
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False  # an older JVM, or another C library than glibc
    return True


def release_driver(spark: SparkSession) -> None:
    """Gives back what finished queries leave on the driver: plans, broadcasts, arrays, freed native memory.

    The JVM grows its heap rather than collect, and its C library keeps what the compiler and
    Spark's many threads have freed; over hundreds of jobs both add up to more than what is in use.
    Collecting also lets Spark drop shuffle files and broadcasts that nothing refers to.
    """
    gc.collect()
    release_memory()
    spark.sparkContext._jvm.System.gc()
    _trim_native_heap(spark)
