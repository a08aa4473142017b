"""Calls that wait for a human, on a stream: paused at once, then approved, rejected or expired.

Calls and decisions are two streams that meet by ``call_id`` in one keyed state. A call of a user whose role is not entitled to the
tool is rejected without asking. The first decision that comes in time counts, whatever comes after it; a call that nobody
decided within ``patience`` expires once the watermark has passed that moment. A decision that comes before its call waits for it.
State is dropped when a call's patience is over. The state is kept by buckets of calls, of which only the open ones are in it:
a batch of many calls costs a few round trips per bucket and not per call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from turnwarden.operators.tool_rules import with_permission

PAUSED, REFUSED, APPROVED, REJECTED, EXPIRED = "paused", "auto-rejected", "approved", "rejected", "expired"


#: Groups of calls, by hash of their id, that share a state; more of them for streams with very many open calls.
BUCKETS = 1024


def _changes(call: list | None, rows: list[tuple], patience_us: int) -> tuple[list, list[tuple]]:
    """A call's new state ``[asked, settled, due, early]`` and the changes ``(status, us, note)`` that its new rows make."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[3]))
    asked, settled, due, early = call or (None, False, None, [])
    decisions, out = [(us, approved, note) for us, kind, _, approved, note in rows if kind == 1], []
    if asked is None:
        first = next((r for r in rows if r[1] == 0), None)
        if first is None:
            return [None, False, decisions[0][0] + patience_us if due is None else due, early + decisions], out
        asked, settled, due = first[0], not first[2], first[0] + patience_us
        out.append((PAUSED if first[2] else REFUSED, asked, None))
        decisions = sorted(decisions + early, key=lambda d: d[:2])
    for at, approved, note in decisions:
        if not settled and asked <= at <= due:
            settled = True
            out.append((APPROVED if approved else REJECTED, at, note))
    return [asked, settled, due, []], out


def _processor(patience_us: int):
    """A function of the new rows and the state of a bucket of calls. A call costs no call of Python or of the state store of its own."""
    def change(key, batches, state):
        import pandas as pd
        calls = {c[0]: [c[1], c[2], c[3], [tuple(d) for d in c[4]]] for c in (state.get[0] if state.exists else ())}
        new, out = {}, []
        if not state.hasTimedOut:
            for pdf in batches:
                for call_id, *row, note in zip(*(pdf[c].tolist() for c in ("call_id", "us", "kind", "allowed", "approved", "note"))):
                    new.setdefault(call_id, []).append((*row, note if isinstance(note, str) else None))
        for call_id, rows in new.items():
            calls[call_id], made = _changes(calls.get(call_id), rows, patience_us)
            out += [(call_id, *m) for m in made]
        watermark = state.getCurrentWatermarkMs()
        for call_id in [c for c, (_, _, due, _) in calls.items() if due // 1000 < watermark]:
            asked, settled, due, _ = calls.pop(call_id)
            if asked is not None and not settled:
                out.append((call_id, EXPIRED, due, None))
        if calls:
            state.update(([(call_id, *c) for call_id, c in calls.items()],))
            state.setTimeoutTimestamp(min(due for _, _, due, _ in calls.values()) // 1000)
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["call_id", "status", "us", "note"])

    return change


def approvals_stream(pending: DataFrame, decisions: DataFrame, users: DataFrame, permissions: DataFrame, patience_seconds: float = 3600,
                     late: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """A row per change of a call: call_id, status, at, note.

    ``pending`` has ``call_id, asked_at, user_id, tool_name``; ``decisions`` has ``call_id, decided_at, approved, note``. Null ids
    are left out; a decision without ``approved`` is a rejection.
    """
    none, kind = F.lit(None), pending.schema["call_id"].dataType.simpleString()
    asked = with_permission(pending, users, permissions).select(
        "call_id", F.col("asked_at").alias("at"), F.lit(0).alias("kind"), "allowed", F.lit(False).alias("approved"), none.cast("string").alias("note"))
    decided = decisions.select("call_id", F.col("decided_at").alias("at"), F.lit(1).alias("kind"), F.lit(False).alias("allowed"),
                               F.coalesce("approved", F.lit(False)).alias("approved"), "note")
    rows = asked.unionByName(decided).filter("call_id is not null and at is not null").withWatermark("at", late).withColumns({
        "us": F.unix_micros("at"), "bucket": F.pmod(F.xxhash64("call_id"), F.lit(buckets))})
    state = f"calls array<struct<call_id: {kind}, asked: bigint, settled: boolean, due: bigint, early: array<struct<at: bigint, approved: boolean, note: string>>>>"
    changes = rows.groupBy("bucket").applyInPandasWithState(
        _processor(int(patience_seconds * 1_000_000)), f"call_id {kind}, status string, us bigint, note string", state,
        "append", GroupStateTimeout.EventTimeTimeout)
    return changes.select("call_id", "status", F.timestamp_micros("us").alias("at"), "note")
