"""Independent tasks: a bounded number at the same time, results in their order, in the caller's job group."""

import threading

from rosterflow import session as S


def test_few_tasks_run_at_the_same_time(spark):
    running, most, lock = 0, 0, threading.Lock()
    met = threading.Barrier(S.MOST_TOGETHER)

    def task(n):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        met.wait(60)  # as many as may run do run at the same time
        rows = spark.range(n).count()
        with lock:
            running -= 1
        return rows

    n = 7 * S.MOST_TOGETHER
    assert S.together(spark, *(lambda k=k: task(k) for k in range(n))) == list(range(n))
    assert most == S.MOST_TOGETHER < n


def test_a_task_may_have_tasks_and_an_error_reaches_the_caller(spark):
    def nested(k):
        return S.together(spark, *(lambda j=j: (k, j, spark.sparkContext.getLocalProperty("callSite.short")) for j in range(5)))

    spark.sparkContext.setLocalProperty("callSite.short", "outside")
    try:
        found = S.together(spark, *(lambda k=k: nested(k) for k in range(5)))
    finally:
        spark.sparkContext.setLocalProperty("callSite.short", None)
    assert found == [[(k, j, "outside") for j in range(5)] for k in range(5)]
    try:
        S.together(spark, lambda: 1, lambda: 1 // 0, lambda: 2)
    except ZeroDivisionError:
        return
    raise AssertionError("the error was lost")


def test_garbage_of_the_driver_is_collected(spark):
    freed = threading.Event()

    class Held:
        def __del__(self):
            freed.set()

    held = Held()
    held.itself = held  # only a collection finds it
    del held
    S.release(spark)
    assert freed.is_set()
