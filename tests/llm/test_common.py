"""Helpers shared by the operators."""

from feedspark.llm import common


def _own_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def test_give_back_returns_pages_between_blocks_in_use():
    got = [bytearray(8000) for _ in range(25_000)]       # 200 MB
    kept = got[::500]
    del got
    before = _own_mb()
    common.give_back()
    assert before - _own_mb() > 100 and len(kept) == 50


def test_steps_collect_the_drivers_garbage_once_its_heap_is_half_grown(spark, monkeypatch):
    assert 0 < common.heap_share(spark) <= 1
    released, share = [], [0.4]
    monkeypatch.setattr(common, "release", released.append)
    monkeypatch.setattr(common, "heap_share", lambda _: share[0])
    for step in (common.cut_lineage, lambda df: common.written(df, "step")):
        share[0] = 0.4
        assert step(spark.range(3)).count() == 3 and not released
        share[0] = 0.6
        assert step(spark.range(3)).count() == 3 and released == [spark]
        released.clear()


def test_the_driver_gives_freed_memory_back(spark, monkeypatch):
    """A release reaches the memory off the heap, too; without the JVM's command it goes on."""
    from feedspark.llm import common
    done, trim = [], common.trim_driver
    monkeypatch.setattr(common, "trim_driver", lambda s: done.append(trim(s)))
    common.release(spark)
    assert done in ([True], [False])
    vm = spark.sparkContext._jvm.java.lang.Runtime.version()
    if spark.sparkContext._jvm.java.lang.System.getProperty("os.name") == "Linux" and vm.feature() >= 18:
        assert done == [True]
