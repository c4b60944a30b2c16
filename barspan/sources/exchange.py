"""Exchanging parts of a store so that a break at any moment loses nothing.

A change is prepared in a folder beside the store (the same storage): new data is written there and the store is left alone.
Then a journal, the ordered list of renames that take old parts out and put new ones in, appears in one step: from here on the change is
certain. Only then parts are renamed. If that breaks off, the next one to open the store finds the journal and does
the renames that are left; each can be told from its two names to be done or not. A folder without a journal is a change
that never became certain and means nothing; ``clean_up`` removes such leftovers.

Readers may come at any time, writers of one store one at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

from barspan.sources.files import exists, list_names, make_folder, move, read_text, remove, write_text

_JOURNAL = "journal.json"


def _changes(path: str) -> str:
    return f"{path.rstrip('/')}__changes"


class Change:
    """New data goes to ``new``, what it replaces to ``old``; ``moves`` are the planned renames in their order."""

    def __init__(self, path: str, folder: str):
        self.path, self.folder = path.rstrip("/"), folder
        self.new, self.old = f"{folder}/new", f"{folder}/old"
        self.moves: list[tuple[str, str]] = []

    def take_out(self, name: str) -> None:
        """Plan to move a part of the store away; the empty name is the store itself."""
        self.moves.append((self._stored(name), f"{self.old}/{name or 'store'}"))

    def put_in(self, new: str, name: str) -> None:
        """Plan to move ``new``, a path below ``self.new`` (or itself, if empty), into the store."""
        self.moves.append((f"{self.new}/{new}".rstrip("/"), self._stored(name)))

    def _stored(self, name: str) -> str:
        return f"{self.path}/{name}" if name else self.path


@contextmanager
def change(spark: SparkSession, path: str) -> Iterator[Change]:
    """Prepare a change inside the block; at its end the planned moves are journalled and made. An error inside leaves the store as it is."""
    recover(spark, path)
    prepared = Change(path, f"{_changes(path)}/{time.time_ns():020d}-{uuid.uuid4().hex}")
    try:
        yield prepared
        if prepared.moves:
            write_text(spark, f"{prepared.folder}/{_JOURNAL}", json.dumps(prepared.moves))
    except BaseException:
        _drop(spark, path, prepared.folder)
        raise
    if prepared.moves:
        _roll_forward(spark, path, prepared.folder, prepared.moves)
    else:
        _drop(spark, path, prepared.folder)


def _roll_forward(spark: SparkSession, path: str, folder: str, moves: Sequence[Sequence[str]]) -> None:
    for source, target in moves:
        # A target that is there, or a source that is not, was moved before the break.
        if not exists(spark, target) and exists(spark, source):
            make_folder(spark, target.rsplit("/", 1)[0])
            _moved(spark, source, target)
    # The journal goes first: what is left then means nothing.
    remove(spark, f"{folder}/{_JOURNAL}")
    _drop(spark, path, folder)


def _moved(spark: SparkSession, source: str, target: str) -> None:
    try:
        move(spark, source, target)
    except OSError:
        # Another one who opened the store may have made the move in between.
        if exists(spark, source) or not exists(spark, target):
            raise


def _drop(spark: SparkSession, path: str, folder: str) -> None:
    remove(spark, folder)
    if not list_names(spark, _changes(path)):
        remove(spark, _changes(path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish changes of the store that are certain but broke off. One look-up if there are none."""
    if not exists(spark, _changes(path)):
        return
    for name in list_names(spark, _changes(path)):
        folder = f"{_changes(path)}/{name}"
        if exists(spark, f"{folder}/{_JOURNAL}"):
            _roll_forward(spark, path, folder, json.loads(read_text(spark, f"{folder}/{_JOURNAL}")))


def clean_up(spark: SparkSession, path: str) -> None:
    """Remove what changes left behind that broke off before they were certain. Not while one is being prepared."""
    recover(spark, path)
    remove(spark, _changes(path))
