"""Loading reviewed rows into a dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from gondola.functions.flags import approved, find_flag_column
from gondola.functions.text import safe_text
from gondola.operators.dimensions import absent_rows
from gondola.operators.review import FLAG
from gondola.operators.schema import ensure_layout, quoted
from gondola.operators.store import Conflict, Store

# Queue column -> dimension column of panel stores.
PANEL_STORE_RENAMES = {
    "Código único PDV": "Id_Comercial",
    "Pdv Clasif 3": "Pdv_Clasif_3",
    "Pdv RUC": "RUC_PDV",
    "PDV_RAZON_SOCIAL": "Razon_Social_PDV",
    "Nombre PDV": "Nombre_PDV",
    "Estado PDV": "Estado_PDV",
    "Localidad PDV": "Localidad_PDV",
    "Dirección PDV": "Direccion_PDV",
}


class Promotion(NamedTuple):
    inserted: DataFrame
    remaining: DataFrame

    def dimension_after(self, dim: DataFrame) -> DataFrame:
        return dim.unionByName(self.inserted)


def with_flag(queue: DataFrame, mode: str) -> DataFrame:
    """The queue with a non-null boolean flag, whatever the column was called or held."""
    found = find_flag_column(queue.columns, FLAG)
    if found is None:
        return queue.withColumn(FLAG, F.lit(False))
    parsed = approved(F.col(quoted(found)), queue.schema[found].dataType, mode)
    return queue.withColumn(found, parsed).withColumnRenamed(found, FLAG)


def promote(
    queue: DataFrame,
    dim: DataFrame,
    key: str,
    mode: str = "lenient",
    renames: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
) -> Promotion:
    """Approved rows to add to the dimension, and the queue that stays.

    Only keys the dimension lacks are inserted, one row each, so running it twice
    changes nothing. An approved row without a key cannot be inserted and stays in
    the queue. Text columns of the dimension are stripped and lose a trailing ``.0``.
    """
    flagged = with_flag(queue, mode)
    queue_key = {new: old for old, new in (renames or {}).items()}.get(key, key)
    named = safe_text(F.col(quoted(queue_key)))
    ready = F.col(FLAG) & F.coalesce(named != "", F.lit(False))
    rows = flagged.filter(ready).drop(FLAG).withColumnsRenamed(dict(renames or {}))
    texts = [f.name for f in dim.schema if isinstance(f.dataType, StringType) and f.name in rows.columns]
    rows = rows.withColumns({c: safe_text(F.col(quoted(c))) for c in texts}) if texts else rows
    rows = ensure_layout(rows, dim.schema)
    return Promotion(absent_rows(rows, dim, key, order_by), flagged.filter(~ready))


def counted(promoted: Promotion) -> DataFrame:
    """One row: rows inserted and rows that stay in the queue."""
    parts = [rows.select(F.lit(part).alias("part")) for rows, part in ((promoted.inserted, "inserted"), (promoted.remaining, "remaining"))]
    both = parts[0].unionByName(parts[1])
    return both.agg(*[F.count_if(F.col("part") == part).alias(part) for part in ("inserted", "remaining")])


#: How often a queue is promoted anew because another load was published meanwhile.
ATTEMPTS = 5


def run(
    store: Store,
    queues: Sequence[str],
    dim: str,
    key: str,
    mode: str = "lenient",
    renames: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    dry_run: bool = False,
) -> DataFrame:
    """Promote several review queues into the dimension ``dim``, all tables of ``store``, in the order of their names.

    Each queue sees the dimension with what the queues before it inserted. Its new rows, the
    queue without them and the record of both counts are published as one, so a run that stops
    anywhere has either promoted a queue or left it; a rerun goes on from there. A queue that
    fails does not stop the others. Returns queue, inserted, remaining and error (NULL if none);
    ``last_promotion`` finds the counts of a run that stopped before it could return them.
    """
    outcomes = []
    for name in sorted(queues):
        try:
            outcomes.append((name, *_promoted(store, name, dim, key, mode, renames, order_by, dry_run), None))
        except Exception as error:  # one bad queue must not hold up the others
            outcomes.append((name, 0, None, f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"))
    return store.spark.createDataFrame(outcomes, "queue string, inserted bigint, remaining bigint, error string")


def _promoted(store: Store, name: str, dim: str, key: str, mode: str, renames, order_by, dry_run: bool) -> tuple[int, int]:
    for attempt in range(ATTEMPTS):
        load, before = store.load(), store.snapshot(name)
        promoted = promote(store.read(name), store.read(dim), key, mode, renames, order_by)
        if dry_run:
            row = counted(promoted).first()
            return row.inserted, row.remaining
        one = {"n": F.count(F.lit(1))}
        inserted = load.put(dim, promoted.inserted, append=True, metrics=one)["n"]
        remaining = load.put(name, promoted.remaining, metrics=one)["n"]
        try:
            load.publish(run="promotion", queue=name, snapshot=list(before), inserted=inserted, remaining=remaining)
            return inserted, remaining
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def last_promotion(store: Store, queue: str) -> dict | None:
    """The record of the queue's last promotion: the snapshot it read, rows inserted and remaining."""
    for version in reversed(store.versions()):
        info = store.manifest(version)["info"]
        if info.get("run") == "promotion" and info["queue"] == queue:
            return info
    return None
