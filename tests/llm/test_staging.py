"""Staged folders belong to the thread that staged them."""

import threading

from turnstile.llm.common import release, staged


def test_release_leaves_the_folders_of_a_run_in_another_thread(spark):
    staged_second, released_first, counts = threading.Event(), threading.Event(), {}

    def first():
        staged_second.wait(120)
        counts["first"] = staged(spark.range(3), "first").count()
        release(spark)
        released_first.set()

    def second():
        rows = staged(spark.range(5), "second")
        staged_second.set()
        released_first.wait(120)
        counts["second"] = rows.count()  # still readable after the other run released its folders
        release(spark)

    threads = [threading.Thread(target=first), threading.Thread(target=second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(300)
    assert counts == {"first": 3, "second": 5}


def test_release_deletes_what_this_thread_staged(spark):
    import glob

    from turnstile.session import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    staged(spark.range(2), "mine").count()
    assert glob.glob(f"{folder}/llm-mine-*")
    release(spark)
    assert not glob.glob(f"{folder}/llm-mine-*")
