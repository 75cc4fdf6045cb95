"""Jobs over many tables go on where they stopped."""

import pytest

from conftest import rows
from tessera.operators.jobledger import Item, JobLedger, files_fingerprint
from tessera.plans.consolidation import consolidate_by_suffix


def test_items_are_done_once(spark, tmp_base):
    done, marks, broken = [], {"a": "1", "b": "1", "c": None}, {"b"}

    def item(name):
        def run():
            done.append(name)
            if name in broken:
                raise ValueError("broken")
            return f"out/{name}", {"n": len(done)}
        return Item(lambda: marks[name], run, lambda output: output not in gone)
    gone = set()
    go = lambda: {o.item: o.state for o in JobLedger(spark, tmp_base).run({n: item(n) for n in "abc"}, max_workers=1)}
    assert go() == {"a": "done", "b": "failed", "c": "done"} and done == ["a", "b", "c"]
    broken.clear()
    assert go() == {"a": "unchanged", "b": "done", "c": "done"}      # what can't be told apart is done again
    marks["a"] = "2"
    assert go() == {"a": "done", "b": "unchanged", "c": "done"}
    gone.add("out/b")
    assert go()["b"] == "done"
    assert JobLedger(spark, tmp_base).entries().where("state = 'failed'").select("error").collect()[0][0] == "ValueError: broken"


def test_a_run_that_died_keeps_what_it_finished(spark, tmp_base):
    def dies():
        raise KeyboardInterrupt
    ledger = JobLedger(spark, tmp_base)
    with pytest.raises(KeyboardInterrupt):
        ledger.run({"a": Item(lambda: "1", lambda: ("o", {})), "b": Item(lambda: "1", dies), "c": Item(lambda: "1", lambda: ("o", {}))}, max_workers=1)
    again = ledger.run({n: Item(lambda: "1", lambda: ("o", {})) for n in "abc"}, max_workers=1)
    assert [o.state for o in again] == ["unchanged", "done", "done"]


def test_combine_job_resumes(spark, tmp_base):
    roots = {n: f"{tmp_base}/in/{n}" for n in ("a_order", "b_order", "a_conf")}
    for k, root in enumerate(roots.values()):
        spark.range(k + 1).write.parquet(root)
    suffixes = {"_order": "orders", "_conf": "confs", "_none": "nothing"}
    go = lambda: rows(consolidate_by_suffix(spark, roots, suffixes, f"{tmp_base}/out", ledger=f"{tmp_base}/ledger"))
    first = go()
    assert first == rows(consolidate_by_suffix(spark, roots, suffixes, f"{tmp_base}/out2"))
    assert {r[0]: r[4] for r in go()} == {"_order": "unchanged", "_conf": "unchanged", "_none": "no match"}
    before = files_fingerprint(spark, roots["a_conf"])
    spark.range(5).write.mode("append").parquet(roots["a_conf"])
    assert files_fingerprint(spark, roots["a_conf"]) != before
    assert {r[0]: (r[3], r[4]) for r in go()} == {"_order": (3, "unchanged"), "_conf": (8, "written"), "_none": (0, "no match")}
    roots["c_order"] = roots["a_order"]
    assert {r[0]: r[4] for r in go()}["_order"] == "written"
