"""Runs of a dataset and their one commit.

A run writes several folders (silver, rejects and what else a job adds); it is
there for readers when its manifest ``<dataset>/_runs/<run_id>.json`` is.  The
manifest is created whole and only if there is none, so of two writers of one
run id exactly one can commit.  Before that a writer takes the run id with a
claim file, created the same way: a second writer is refused before it writes
anything.  A writer that fails removes its folders and its claim; one that was
killed leaves both, invisible to readers, until ``clean_abandoned`` removes
them.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake.lake import create_once, delete_folder, hadoop_fs, list_names, path_exists, read_text

RUNS_FOLDER = "_runs"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("start", T.StringType()), T.StructField("end", T.StringType()),
    T.StructField("committed_at", T.StringType()), T.StructField("folders", T.MapType(T.StringType(), T.StringType())),
    T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType()))])


class UncommittedRun(FileNotFoundError):
    """A run folder without a manifest: still being written, or left by a writer that was killed."""


@dataclasses.dataclass
class Run:
    """A claimed run; ``folders`` are what it writes, by name."""
    spark: SparkSession
    dataset_root: str
    run_id: str
    folders: dict[str, str]
    token: str

    def attach(self, name: str, text: str) -> None:
        """A small text kept beside the manifest, there for readers with the commit."""
        create_once(self.spark, f"{self.dataset_root}/{RUNS_FOLDER}/{self.run_id}.{name}", text)

    def commit(self, start=None, end=None, counts: dict[str, int] | None = None, extra: dict[str, str] | None = None) -> dict:
        """Makes the run visible; all its folders must be written."""
        if _owner(self.spark, _claim_path(self.dataset_root, self.run_id)) != self.token:
            raise UncommittedRun(f"the claim of run {self.run_id} is gone: it was cleaned up as abandoned")
        manifest = {"run_id": self.run_id, "dataset": self.dataset_root.rstrip("/").rsplit("/", 1)[-1],
                    "start": None if start is None else str(start), "end": None if end is None else str(end),
                    "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
                    "folders": self.folders, "counts": {k: int(v) for k, v in (counts or {}).items()},
                    "extra": {k: str(v) for k, v in (extra or {}).items()}}
        create_once(self.spark, _manifest_path(self.dataset_root, self.run_id), json.dumps(manifest))
        return manifest


def _manifest_path(dataset_root: str, run_id: str) -> str:
    return f"{dataset_root}/{RUNS_FOLDER}/{run_id}.json"


def _claim_path(dataset_root: str, run_id: str) -> str:
    return f"{dataset_root}/{RUNS_FOLDER}/{run_id}.claim"


def _owner(spark: SparkSession, claim: str) -> str | None:
    return json.loads(read_text(spark, claim))["token"] if path_exists(spark, claim) else None


@contextlib.contextmanager
def writing(spark: SparkSession, dataset_root: str, run_id: str, folders: dict[str, str]) -> Iterator[Run]:
    """Claims ``run_id``; what a failing writer wrote is removed and the id is free again."""
    run = Run(spark, dataset_root, run_id, dict(folders), uuid.uuid4().hex)
    if path_exists(spark, _manifest_path(dataset_root, run_id)):
        raise FileExistsError(f"run {run_id} is committed")
    claim = _claim_path(dataset_root, run_id)
    create_once(spark, claim, json.dumps({"token": run.token, "folders": run.folders}))
    try:
        there = [f for f in run.folders.values() if path_exists(spark, f)]
        if there or path_exists(spark, _manifest_path(dataset_root, run_id)):
            run.folders = {}  # they are another's
            raise FileExistsError(f"run {run_id} exists: {there}")
        yield run
    except BaseException:
        if not path_exists(spark, _manifest_path(dataset_root, run_id)):
            for folder in run.folders.values():
                delete_folder(spark, folder)
            _delete_attached(spark, dataset_root, run_id)
            delete_folder(spark, claim)
        raise


def _delete_attached(spark: SparkSession, dataset_root: str, run_id: str) -> None:
    folder = f"{dataset_root}/{RUNS_FOLDER}"
    for name in list_names(spark, folder):
        if name.startswith(f"{run_id}.") and name.rsplit(".", 1)[1] not in ("claim", "json"):
            delete_folder(spark, f"{folder}/{name}")


def committed_ids(spark: SparkSession, dataset_root: str) -> list[str]:
    """Committed runs, oldest window first: one listing of names, no file is opened."""
    return sorted(n.removesuffix(".json") for n in list_names(spark, f"{dataset_root}/{RUNS_FOLDER}") if n.endswith(".json"))


def manifest(spark: SparkSession, dataset_root: str, run_id: str) -> dict:
    path = _manifest_path(dataset_root, run_id)
    if not path_exists(spark, path):
        raise UncommittedRun(f"{run_id} is not a committed run of {dataset_root}")
    return json.loads(read_text(spark, path))


def manifests(spark: SparkSession, dataset_root: str) -> DataFrame:
    """One row a committed run (``MANIFEST_SCHEMA``), read from the manifests alone."""
    paths = [_manifest_path(dataset_root, r) for r in committed_ids(spark, dataset_root)]
    if not paths:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(paths)


def attached(spark: SparkSession, dataset_root: str, name: str, *run_ids: str) -> DataFrame:
    """``(run_id, value)`` of the texts of that name beside the manifests of committed runs (all, or those named)."""
    there = set(list_names(spark, f"{dataset_root}/{RUNS_FOLDER}"))
    ids = [r for r in run_ids or committed_ids(spark, dataset_root) if f"{r}.{name}" in there and f"{r}.json" in there]
    if not ids:
        return spark.createDataFrame([], "run_id string, value string")
    texts = spark.read.option("wholetext", True).text([f"{dataset_root}/{RUNS_FOLDER}/{r}.{name}" for r in ids])
    file_name = F.regexp_extract("_metadata.file_name", rf"^(.*)\.{name}$", 1)
    return texts.select(file_name.alias("run_id"), "value")


def check_committed(spark: SparkSession, run_dir: str) -> None:
    """Raises for a ``.../run_id=<id>`` folder that is not a committed run; other folders are the caller's own."""
    root, _, name = run_dir.rstrip("/").rpartition("/")
    if name.startswith("run_id="):
        run_id = name.removeprefix("run_id=")
        if not path_exists(spark, _manifest_path(root, run_id)):
            raise UncommittedRun(run_dir)


def clean_abandoned(spark: SparkSession, dataset_root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Removes claims without a manifest that are older than that, and the folders they name; returns their run ids.

    ``older_than`` must exceed the longest run: a writer still at work loses
    its claim and cannot commit.
    """
    folder = f"{dataset_root}/{RUNS_FOLDER}"
    names = list_names(spark, folder)
    gone = []
    for name in names:
        if not name.endswith(".claim") or name.removesuffix(".claim") + ".json" in names:
            continue
        path, fs = hadoop_fs(spark, f"{folder}/{name}")
        age = dt.datetime.now(dt.timezone.utc).timestamp() - fs.getFileStatus(path).getModificationTime() / 1000
        if age < older_than.total_seconds():
            continue
        claim = json.loads(read_text(spark, f"{folder}/{name}"))
        delete_folder(spark, f"{folder}/{name}")  # first: from here on its writer cannot commit
        _delete_attached(spark, dataset_root, name.removesuffix(".claim"))
        for f in claim["folders"].values():
            delete_folder(spark, f)
        gone.append(name.removesuffix(".claim"))
    return sorted(gone)
