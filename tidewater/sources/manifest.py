"""Versioned manifests: what a stored table consists of, one small JSON file a commit.

A reader lists the manifest folder once and reads its newest file; nothing else
is listed or probed. A commit writes the next version aside and moves it into
place in one step, so a version is there whole or not at all, and a writer that
lost the race for a number learns of it. Old versions stay readable until they
are expired, which makes reads as of a version possible.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from . import files


class Conflict(RuntimeError):
    """Another writer committed the version first; read again and retry."""


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return files.numbered(self.spark, self.path, "", ".json")

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"

    def at(self, version: int) -> dict:
        return json.loads(files.read_text(self.spark, self._file(version)))

    def latest(self) -> dict | None:
        """The newest version's content (None before the first commit)."""
        found = self.versions()
        return self.at(found[-1]) if found else None

    def commit(self, content: dict, after: dict | None) -> dict:
        """Write ``content`` as the version that follows ``after``; raises ``Conflict`` if that exists."""
        version = 0 if after is None else after["version"] + 1
        content = {**content, "version": version, "time": time.time(), "commit": uuid.uuid4().hex}
        aside = f"{self.path}/_aside-{content['commit']}"
        files.write_text(self.spark, aside, json.dumps(content))
        try:
            files.move(self.spark, aside, self._file(version))
        except FileExistsError as e:
            files.remove(self.spark, aside)
            raise Conflict(f"version {version} of {self.path} is there already") from e
        if self.at(version)["commit"] != content["commit"]:
            raise Conflict(f"version {version} of {self.path} was written by another")
        return content

    def forget(self, versions: list[int]) -> None:
        for v in versions:
            files.remove(self.spark, self._file(v))
