"""Workflow configuration, checks before a run, and stages whose state is kept."""

from __future__ import annotations

import hashlib
import importlib.util
import json
from collections.abc import Callable
from dataclasses import MISSING, dataclass, fields

from pyspark.sql import SparkSession

from .errors import StateConflict, TidewellError
from .plans import rules as R
from .plans.publish import Store

STAGES = ("plan", "ledger", "pack", "finalize")


@dataclass(frozen=True)
class Workflow:
    """What a run needs; paths are as Spark (and, for archives and packs, the executors) see them."""

    anchor_logs: str
    native_logs: str
    scene_filter: str
    train_manifest: str
    val_manifest: str
    archive_root: str
    work_root: str
    existing_root: str = ""
    archive_base_url: str = ""
    scene_filter_sha256: str = ""
    prefix: str = "public"
    root_name: str = "sensors"
    channels: str = ""
    checkpoint: int = 500
    archives_per_batch: int = 8
    minimum_free_gb: float = 0
    resume_free_gb: float = 0
    poll_seconds: float = 300
    audit_samples: int = 6
    audit_seed: int = 0
    audit_channel: str = "CAM_F0"

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Workflow:
        """From YAML: one mapping, known keys only, each of its kind; all faults are named together."""
        import yaml

        spec = yaml.safe_load(Store(spark, path).read_text(path))
        if not isinstance(spec, dict):
            raise TidewellError(f"{path}: not a mapping")
        kinds = {f.name: f.type for f in fields(cls)}
        faults = [f"unknown key {k!r}" for k in spec if k not in kinds]
        faults += [f"missing key {f.name!r}" for f in fields(cls) if f.name not in spec and f.default is MISSING]
        for k, v in spec.items():
            want = {"str": str, "int": int, "float": (int, float)}.get(kinds.get(k, ""), object)
            if not isinstance(v, want) or isinstance(v, bool):
                faults.append(f"{k!r} is {type(v).__name__}")
        if not faults:
            out = cls(**spec)
            try:
                if out.archive_base_url:
                    R.require_https(out.archive_base_url)
                R.check_arguments(counts={"checkpoint": (out.checkpoint, 1, 1 << 30), "archives_per_batch": (out.archives_per_batch, 1, 1 << 30), "audit_samples": (out.audit_samples, 1, 200)})
                R.reject_held_out([out.anchor_logs, out.native_logs, out.archive_root])
                return out
            except ValueError as error:
                faults.append(str(error))
        raise TidewellError(f"{path}: {'; '.join(faults)}")

    def at(self, name: str) -> str:
        return f"{self.work_root.rstrip('/')}/{name}"

    def identity(self) -> str:
        return hashlib.sha256(json.dumps({f.name: getattr(self, f.name) for f in fields(self)}, sort_keys=True).encode()).hexdigest()


def doctor(spark: SparkSession, flow: Workflow) -> dict:
    """Everything that would stop a run, named together: folders, the pinned filter, modules, free space."""
    errors = []
    for name in ("scene_filter", "train_manifest", "val_manifest", "archive_root", *(["existing_root"] if flow.existing_root else [])):
        path = getattr(flow, name)
        if not Store(spark, path).exists(path):
            errors.append(f"{name}: {path} is not there")
    store = Store(spark, flow.scene_filter)
    if flow.scene_filter_sha256 and store.exists(flow.scene_filter):
        have = hashlib.sha256(store.read_text(flow.scene_filter).encode()).hexdigest()
        if have != flow.scene_filter_sha256:
            errors.append(f"scene_filter: SHA-256 is {have}")
    errors += [f"module {m} is missing" for m in ("yaml", "pandas", "pyarrow") if importlib.util.find_spec(m) is None]
    work = Store(spark, flow.work_root)
    folder = flow.work_root if work.exists(flow.work_root) else flow.work_root.rstrip("/").rpartition("/")[0] or "/"
    free = work.free_bytes(folder)
    if free < flow.minimum_free_gb * 1e9:
        errors.append(f"{free / 1e9:.1f} GB free, {flow.minimum_free_gb} wanted")
    return {"status": "fail" if errors else "pass", "errors": errors, "free_gb": round(free / 1e9, 3)}


class StageState:
    """Which stages of a workflow are done, in a document that is replaced whole; bound to the workflow's configuration."""

    def __init__(self, spark: SparkSession, flow: Workflow):
        self.store, self.path, self.identity = Store(spark, flow.work_root), flow.at("stages.json"), flow.identity()

    def read(self) -> dict[str, dict]:
        if not self.store.exists(self.path):
            return {}
        held = json.loads(self.store.read_text(self.path))
        if held["workflow"] != self.identity:
            raise StateConflict(f"{self.path} belongs to another configuration")
        return held["stages"]

    def run(self, name: str, stage: Callable[[], dict]) -> dict:
        """The stage's report; a stage that has passed is not run again."""
        done = self.read()
        if done.get(name, {}).get("status") == "pass":
            return done[name]
        report = stage()
        done = self.read() | {name: report}
        self.store.replace_text(self.path, json.dumps({"workflow": self.identity, "stages": done}, sort_keys=True, indent=2))
        return report
