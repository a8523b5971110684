"""Batches that become visible as a whole.

A batch writes bronze, silver, marts and a dozen logs. Before the first of these writes it leaves a
marker that names the versions its tables have; removing the marker, after the last write, is the
one commit of all of them. Readers leave out the rows of marked batches and read the tables at the
versions of the marker, so a run that dies between two writes has shown nothing. What it wrote is
taken back before the next batch of its feed, or by ``Warehouse.recover``.

Markers are files named by batch and state:

- ``open``: running, or dead. Its tables are held at their versions, nothing of it is visible.
- ``failed``: a step raised. The tables are as before; steps, lineage events and alerts are visible.
- ``undone``: died and was taken back. Nothing is visible, what it landed can be finished.

A feed has one writer at a time. A batch that finds its marker gone does not commit.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from tierline.operators.tables import read_text, write_text

OPEN, FAILED, UNDONE = "open", "failed", "undone"


@dataclass(frozen=True)
class Held:
    """A table that an open batch writes to, at the versions it had before (0: it had none)."""

    batch_id: str
    place: str
    snapshot: int
    manifest: int


class BatchJournal:
    """The markers of the batches of a warehouse that are not committed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _file(self, batch_id: str, state: str) -> str:
        return f"{self.root}/{quote(batch_id, safe='')}.{state}"

    def _marked(self) -> set[tuple[str, str]]:
        fs, folder = self._path(self.root)
        if not fs.exists(folder):
            return set()
        names = [s.getPath().getName().rpartition(".") for s in fs.listStatus(folder)]
        return {(unquote(name), state) for name, _, state in names if state in (OPEN, FAILED, UNDONE)}

    def states(self) -> dict[str, str]:
        """Batches that are not committed. A failed or dead one that is run again is open."""
        found: dict[str, str] = {}
        for batch_id, state in sorted(self._marked(), key=lambda m: (UNDONE, FAILED, OPEN).index(m[1])):
            found[batch_id] = state
        return found

    def hidden(self, *, but_failed: bool = False) -> frozenset[str]:
        """Batches whose rows are not to be seen; ``but_failed`` for the logs that tell of failures."""
        return frozenset(b for b, state in self.states().items() if not (but_failed and state == FAILED))

    def _entry(self, batch_id: str) -> dict:
        text = read_text(self.spark, self._file(batch_id, OPEN))
        # Committed since the markers were listed.
        return {"feed": None, "tables": []} if text is None else json.loads(text)

    def held(self, batch_id: str) -> list[Held]:
        return [Held(batch_id, *t) for t in self._entry(batch_id)["tables"]]

    def held_at(self, place: str) -> list[Held]:
        """What open batches say about one table."""
        return [h for b, state in self.states().items() if state == OPEN for h in self.held(b) if h.place == place]

    def open_batches(self, feed: str | None = None) -> list[str]:
        """Open batches of a feed, or of all."""
        found = [b for b, state in self.states().items() if state == OPEN]
        return sorted(b for b in found if feed is None or self._entry(b)["feed"] == feed)

    def begin(self, batch_id: str, feed: str, tables: dict[str, tuple[int, int]]) -> None:
        """Marks a batch before its first write. ``tables``: snapshot and manifest version by place."""
        for other in self.open_batches():
            shared = sorted({h.place for h in self.held(other)} & tables.keys())
            if shared:
                raise RuntimeError(f"{shared} are held by batch {other!r}; if it no longer runs, recover() the warehouse")
        entry = {"feed": feed, "tables": [[place, *versions] for place, versions in sorted(tables.items())]}
        write_text(self.spark, self._file(batch_id, OPEN), json.dumps(entry))

    def _remove(self, batch_id: str, state: str) -> bool:
        fs, path = self._path(self._file(batch_id, state))
        return bool(fs.delete(path, False))

    def commit(self, batch_id: str) -> None:
        """Makes all that a batch wrote visible: the marker that goes last is the commit."""
        if (batch_id, OPEN) not in self._marked():
            raise RuntimeError(f"batch {batch_id!r} was taken back by another run and is not committed")
        for state in (FAILED, UNDONE):
            self._remove(batch_id, state)
        if not self._remove(batch_id, OPEN):
            raise RuntimeError(f"batch {batch_id!r} was taken back by another run and is not committed")

    def close(self, batch_id: str, state: str) -> None:
        """Ends an open batch without a commit, once its tables are as before."""
        write_text(self.spark, self._file(batch_id, state), "")
        self._remove(batch_id, OPEN)
