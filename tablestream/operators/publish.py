"""Diff, publish and audit of a table's branches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tablestream.operators import keyed
from tablestream.operators.changelog import FORK, MAIN, EventTable, HeadMoved, Layer
from tablestream.schemas import KEYED
from tablestream.session import settle


class PublishRefused(RuntimeError):
    """Conflicting keys, a moved target or a failed audit; nothing was written.

    ``offending`` holds the rows that each failed check found.
    """

    def __init__(self, reason: str, offending: dict[str, DataFrame] | None = None) -> None:
        super().__init__(reason)
        self.offending = offending or {}


def _fork(table: EventTable, branch: str, into: str) -> Row:
    """The newest fork of ``branch``, which must be one of ``into``."""
    row = (
        table.versions(branch)
        .where(F.col("operation") == FORK)
        .orderBy(F.desc("batch_id"))
        .select("fork_batch", "source_branch", "covers")
        .first()
    )
    if row is None:
        raise PublishRefused(f"{branch} was not forked from another branch")
    if row.source_branch != into:
        raise PublishRefused(f"{branch} was forked from {row.source_branch}, not {into}")
    return row


def diff(
    table: EventTable,
    branch: str,
    into: str = MAIN,
    version: int | None = None,
    head: int | None = None,
) -> DataFrame:
    """Keys the branch changed since its fork, with ``change`` per key.

    ``version`` and ``head`` pin what is compared of the branch and of ``into``.
    """
    if table.spec.kind != KEYED:
        raise ValueError(f"{table.spec.name} has no keys to compare")
    fork = _fork(table, branch, into)
    version = table.latest_version(branch) if version is None else version
    head = table.latest_version(into) if head is None else head
    ours = table.layer_changes(Layer(branch, fork.covers, version))
    theirs = table.layer_changes(Layer(into, fork.fork_batch, head))
    order = ("batch_id", *table.spec.order)
    return keyed.branch_diff(ours, theirs, table.spec.key, fork.fork_batch, order)


def publish(
    table: EventTable,
    branch: str,
    into: str = MAIN,
    expected_head: int | None = None,
    version: int | None = None,
) -> int:
    """Append the branch's rows up to ``version`` to ``into`` as one batch.

    A keyed table gets the last row of each changed key, and is refused when a key
    changed on both sides since the fork. Appended rows and partial sums add up in
    any order and never conflict. Refused, too, when the target's head is no longer
    ``expected_head``. Afterwards the branch starts again from the new head, with
    what it got after ``version`` on top. A publish that broke off before that is
    completed by the next one.
    """
    version = table.latest_version(branch) if version is None else version
    writer = f"publish:{branch}"
    fork = _fork(table, branch, into)
    mine = (F.col("writer") == writer) & (F.col("batch_id") > fork.fork_batch)
    broken_off = (
        table.versions(into).where(mine).orderBy(F.desc("batch_id")).select("batch_id", "writer_batch").first()
    )
    if broken_off is not None:
        table.refork(branch, into, broken_off.batch_id, broken_off.writer_batch)
        if broken_off.writer_batch >= version:
            return broken_off.batch_id
        fork = _fork(table, branch, into)
    if version <= fork.covers:
        return fork.fork_batch
    head = table.latest_version(into)
    if expected_head is not None and head != expected_head:
        raise PublishRefused(f"{into} moved from {expected_head} to {head}")
    if table.spec.kind == KEYED:
        changes = settle(diff(table, branch, into, version, head), "publish")
        conflicts = changes.where(F.col("change") == "conflict").select(*table.spec.key)
        sample = conflicts.limit(5).collect()
        if sample:
            raise PublishRefused(f"changed on both {branch} and {into}, for example {sample}")
    else:
        changes = table.layer_changes(Layer(branch, fork.covers, version))
    try:
        batch_id = table.append(
            changes, into, writer=writer, writer_batch=version, expected_head=head
        )
    except HeadMoved as moved:
        raise PublishRefused(str(moved)) from moved
    table.refork(branch, into, batch_id, version)
    return batch_id


def _kept(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder, if files can hold their columns."""
    names, types = [c.lower() for c in rows.columns], rows.schema.simpleString()
    odd = not names or len({*names}) < len(names) or "void" in types or "interval" in types
    return rows if odd else settle(rows, "offending")


def audited_publish(
    table: EventTable,
    branch: str,
    checks: dict[str, Callable[[DataFrame], DataFrame]],
    into: str = MAIN,
) -> int:
    """Write-audit-publish: each check returns the offending rows of the branch.

    What is published is the version that was audited; later rows stay on the branch.
    """
    head, version = table.latest_version(into), table.latest_version(branch)
    state = table.read(branch, version)
    # Kept, so that whoever mends the branch need not read its whole state again.
    found = {name: _kept(check(state)) for name, check in checks.items()}
    failed = {name: rows for name, rows in found.items() if not rows.isEmpty()}
    if failed:
        raise PublishRefused(f"{branch} failed {', '.join(sorted(failed))}", failed)
    return publish(table, branch, into, expected_head=head, version=version)
