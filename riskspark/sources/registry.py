"""Models by name: immutable versions and a pointer to the one in use.

``root/name/versions/<version>/`` holds the model, and in ``card.json`` its
training columns (name and type, in order) and categorical levels.
``root/name/current`` holds the version in use. A version is written in full
before the pointer moves, and the pointer moves by one renaming over the old
file: readers find the old version or the new one. Renaming is atomic on a
local file system and HDFS; an object store needs a file system layer that
makes it so.

A folder that lacks its card (a save that did not end) is no version and is
never pointed at. Old versions stay until :func:`drop_version`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.calibration import CalibratedModel
from riskspark.operators.scoring import Scorecard, Term, align_columns, score_batch
from riskspark.schema import DECISION_THRESHOLD


@dataclass(frozen=True)
class RegisteredModel:
    """A loaded version with what it was trained on."""
    name: str
    version: str
    model: object
    columns: dict[str, str]
    levels: dict[str, list[str]] = field(default_factory=dict)

    def score(self, df: DataFrame, keep: list[str] = (), threshold: float = DECISION_THRESHOLD,
              align: bool = False) -> DataFrame:
        """``score_batch`` with the training columns and levels of this version.
        ``align``: columns that the batch lacks are NULL instead of an error."""
        if align:
            df = align_columns(df, list(self.columns), self.columns, keep)
        return score_batch(df, self.model, threshold, list(self.columns), self.levels)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write(self, text: str, *parts: str) -> None:
        stream = self._fs().create(self._path(*parts), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _read(self, *parts: str) -> str | None:
        fs, path = self._fs(), self._path(*parts)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def save(self, name: str, model, columns: dict[str, str], levels: dict[str, list[str]] | None = None,
             use: bool = True) -> str:
        """Write ``model`` as a new version and (``use``) point at it."""
        if not name or "/" in name:
            raise ValueError("a model needs a name without '/'")
        version = uuid.uuid4().hex
        where = (name, "versions", version)
        card = {"columns": columns, "levels": levels or {}, "scorecard": None}
        if isinstance(model, Scorecard):
            card["scorecard"] = asdict(model)
        else:
            model.save("/".join((self.root, *where, "model")))
        self._write(json.dumps(card), *where, "card.json")
        if use:
            self.use(name, version)
        return version

    def use(self, name: str, version: str) -> None:
        """Point ``name`` at a version that is there in full."""
        if self._read(name, "versions", version, "card.json") is None:
            raise ValueError(f"{name} has no version {version}")
        draft = f"current.{uuid.uuid4().hex}"
        self._write(version, name, draft)
        fs = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        options[0] = getattr(fs, "Options$Rename").OVERWRITE
        target = self._fs().makeQualified(self._path(name, "current"))
        files = fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(self._fs().makeQualified(self._path(name, draft)), target, options)

    def current(self, name: str) -> str | None:
        """The version in use, None if there is none."""
        return self._read(name, "current")

    def versions(self, name: str) -> list[str]:
        """All versions saved in full, oldest first."""
        fs, path = self._fs(), self._path(name, "versions")
        if not fs.exists(path):
            return []
        cards = [self._path(name, "versions", s.getPath().getName(), "card.json") for s in fs.listStatus(path)]
        done = [(fs.getFileStatus(c).getModificationTime(), c.getParent().getName()) for c in cards if fs.exists(c)]
        return [v for _, v in sorted(done)]

    def load(self, name: str, version: str | None = None) -> RegisteredModel:
        """The version in use, or the one named."""
        version = version or self.current(name)
        text = version and self._read(name, "versions", version, "card.json")
        if not text:
            raise ValueError(f"no model {name}" + (f" of version {version}" if version else ""))
        card = json.loads(text)
        made = card["scorecard"]
        if made:
            model = Scorecard(**{**made, "terms": tuple(Term(**t) for t in made["terms"])})
        else:
            model = CalibratedModel.load("/".join((self.root, name, "versions", version, "model")), name)
        return RegisteredModel(name, version, model, card["columns"], card["levels"])

    def drop_version(self, name: str, version: str) -> None:
        """Delete a version that is not in use."""
        if version == self.current(name):
            raise ValueError(f"version {version} of {name} is in use")
        self._fs().delete(self._path(name, "versions", version), True)
