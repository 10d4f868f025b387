"""A journal of the steps of a flow, so that a flow that failed goes on where it stopped.

A step is entered when it has finished, with what it was given and what it gave. A second start with the
same journal takes the results of finished steps and runs the rest. A step that is given something else (the
output of a step that ran again has another path) runs again, and so does one whose output is gone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from millrace import storage

# The endings of a step's files.
RESULT, DONE, BEGUN = ".json", ".done", ".begun"

Value = str | int | float | None


@dataclass(frozen=True)
class Journal:
    """The journal in a folder of its own. One flow writes it at a time."""

    spark: SparkSession
    folder: str

    def _entry(self, step: str, given: Mapping[str, Value]) -> str:
        text = json.dumps(dict(given), sort_keys=True)
        return f"{self.folder.rstrip('/')}/{step}.{hashlib.sha256(text.encode()).hexdigest()[:16]}"

    def step(
        self,
        name: str,
        given: Mapping[str, Value],
        work: Callable[[], Mapping[str, Value]],
        outputs: Sequence[str] = (),
    ) -> dict[str, Value]:
        """The result of a step: of the run that has finished with the same ``given``, or of ``work`` now.

        ``outputs`` names the entries of the result that are paths, which must still be there. The result is
        written first and an empty file that makes it count last, so a driver that dies leaves a step finished or not.
        """
        entry = self._entry(name, given)
        if storage.exists(self.spark, entry + DONE):
            result = json.loads(storage.read_bytes(self.spark, entry + RESULT))
            if all(storage.exists(self.spark, result[o]) for o in outputs):
                return result
            storage.delete(self.spark, entry + DONE)
        storage.create_empty(self.spark, f"{entry}.{self._begun(entry)}{BEGUN}")
        result = dict(work())
        storage.write_bytes(self.spark, entry + RESULT, json.dumps(result).encode())
        storage.create_empty(self.spark, entry + DONE)
        return result

    def _begun(self, entry: str) -> int:
        name = entry.rsplit("/", 1)[1]
        found = storage.children(self.spark, self.folder)
        return sum(n.startswith(f"{name}.") and n.endswith(BEGUN) for n in found)

    def runs(self) -> dict[str, tuple[int, int]]:
        """How often each step was begun, and how many of these have a result that counts."""
        found: dict[str, tuple[int, int]] = {}
        for name in storage.children(self.spark, self.folder):
            step = name.split(".", 1)[0]
            begun, done = found.get(step, (0, 0))
            found[step] = (begun + name.endswith(BEGUN), done + name.endswith(DONE))
        return found


def no_journal(
    name: str, given: Mapping[str, Value], work: Callable[[], Mapping[str, Value]], outputs: Sequence[str] = ()
) -> Mapping[str, Value]:
    """A step of a flow that keeps no journal."""
    return work()
