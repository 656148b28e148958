"""A re-read upload folder: old files are not parsed again, labels are those of the whole folder."""

import os
import time

import pytest
from test_jobs import HISTORY, local, write

from lotgate.plans import reread
from lotgate.plans.jobs import STAGING_TABLE, batch_validation, history_migration, setup_store
from lotgate.session import scratch_path

HEAD = "Batch Name,Process,Manufacturer,DoM,Unit Operation,Parameter,Value"


@pytest.fixture()
def root(spark):
    root, hist = scratch_path(spark, "reread"), scratch_path(spark, "reread-hist")
    setup_store(spark, root)
    write(hist, "history.csv", HISTORY)
    history_migration(spark, root, os.path.join(hist, "history.csv"))
    return root


def old(folder, name, text, age):
    write(folder, name, text)
    at = time.time() - age
    os.utime(os.path.join(local(folder), name), (at, at))


def staged(store):
    frame = store.read(STAGING_TABLE).drop("load_timestamp")
    return frame.columns, sorted(map(str, frame.collect()))


def test_only_new_and_changed_files_are_parsed(spark, root, monkeypatch):
    parsed = []
    read = reread.read_uploads
    monkeypatch.setattr(reread, "read_uploads", lambda s, paths, *rest: parsed.append([os.path.basename(p) for p in paths]) or read(s, paths, *rest))
    up = scratch_path(spark, "reread-up")
    whole = scratch_path(spark, "reread-whole")
    full = setup_store(spark, whole)
    store = reread_store(spark, root)

    def run():
        batch_validation(spark, root, up)
        hist = scratch_path(spark, "reread-hist2")
        write(hist, "history.csv", HISTORY)
        setup_store(spark, whole, reset=True)
        history_migration(spark, whole, os.path.join(hist, "history.csv"))
        batch_validation(spark, whole, up, reuse=False)
        assert staged(store) == staged(full)

    old(up, "a.csv", f"{HEAD}\nK7,Main,Maker A,3/7/2026,A,Time,1\nK8,Main,Maker B,3/7/2026,B,Mix,2\n", 500)
    old(up, "b.csv", f'Note,{HEAD}\n"two\nlines",K1,Main,Maker A,1/5/2026,A,Time,41\n', 500)
    run()
    # c.csv contradicts a row of a.csv, which is not parsed again.
    old(up, "c.csv", f"{HEAD},Comment\nK7,Main,Maker B,3/7/2026,A,Flow,1,late\n", 400)
    run()
    assert {r["rejection_stage"] for r in store.read(STAGING_TABLE).where("`Batch Name` = 'K7'").collect()} == {"batch_metadata"}
    run()  # nothing new
    old(up, "b.csv", f"{HEAD}\nK1,Main,Maker A,1/5/2026,A,Time,43\n", 300)
    run()
    assert "Note" not in store.read(STAGING_TABLE).columns
    os.rename(os.path.join(local(up), "a.csv"), os.path.join(local(up), "a.done"))
    run()
    assert parsed == [["a.csv", "b.csv"], ["c.csv"], ["b.csv"]]
    assert store.read(STAGING_TABLE).where("`Batch Name` = 'K8'").count() == 0


def reread_store(spark, root):
    from lotgate.plans.publish import ModelStore
    return ModelStore(root, spark)


def test_a_file_just_written_is_parsed_again(spark, root):
    up = scratch_path(spark, "reread-new")
    write(up, "a.csv", f"{HEAD}\nK1,Main,Maker A,1/5/2026,A,Time,41\n")
    model = reread_store(spark, root).read_model()
    first = reread.parsed_uploads(spark, up, model)
    assert first.parsed_files == ["a.csv"] and first.changes[reread.FILES_TABLE].count() == 0
    batch_validation(spark, root, up)
    assert reread.parsed_uploads(spark, up, reread_store(spark, root).read_model()).parsed_files == ["a.csv"]
