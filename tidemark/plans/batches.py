"""A batch from raw files to published indicators: register, cleanse, merge, gate, publish, or leave all as it was.

Tables are written to versioned folders; the last entry of a log names the versions that count, and is added last, so a
batch that fails or is killed on the way leaves nothing behind that readers see. Every batch has a log of its states.
A batch is skipped only if it was loaded; a failed one may come again, one that somebody else holds may not, until its
lease ends. One batch at a time writes: a lock over all batches says which, and the log of versions takes an entry only
behind the one that its writer has read, so that no writer undoes another's tables even without the lock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, scd2
from ..operators.pit import resolve_sk
from ..operators.rules import accepted, rejected
from ..sources import readers, sinks
from ..sources.star import Star
from ..sources.store import Store
from . import entities, kpis, quality

POINTER, WRITER = "control/gold", "control/writer"
DIMS = {"customers": ("dim_customer", "customer_sk"), "branches": ("dim_branch", "branch_sk"), "products": ("dim_product", "product_sk")}
#: Fact columns that count as values when a row comes again.
FACT_VALUES = ["account_id", "product_id", "branch_id", "transaction_date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund"]
#: Seconds after which the lock of a batch that has not been heard of may be taken over.
LEASE = 6 * 3600
RUNNING = ("RECEIVED", "VALIDATED", "PROCESSING")


@dataclass(frozen=True)
class Batch:
    """What a delivery is: files by entity, and for incremental loads the cutoff from which changes hold."""

    batch_id: str
    load_type: str
    dt: str
    files: dict[str, str]
    cutoff: datetime | None = None
    schema_version: str = "1"
    reject_limit: float = 0.25
    as_of: str = entities.AS_OF
    source_names: dict[str, str] = field(default_factory=dict)


class GateError(RuntimeError):
    """A batch whose counts do not add up, or with too many rejects."""


class BusyError(RuntimeError):
    """Somebody else is writing, or has written meanwhile; the batch may be run again."""


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def _expiry(lease: float) -> str:
    return (datetime.now(timezone.utc) + timedelta(seconds=lease)).isoformat()


def _expired(value: dict) -> bool:
    return datetime.fromisoformat(value["expires"]) <= datetime.now(timezone.utc)


def item_of(batch_id: str) -> str:
    return f"control/batches/{batch_id}"


def status(store: Store, batch_id: str) -> dict | None:
    """The last state of a batch: batch_id, status, owner, at, expires and, of failures, error."""
    return store.latest(item_of(batch_id))[1]


class Lock:
    """A log whose last entry says who holds it and until when; every further entry must come from its holder."""

    def __init__(self, store: Store, log: str, owner: str, lease: float):
        self.store, self.log, self.owner, self.lease, self.at = store, log, owner, lease, -1

    def take(self, free: Callable[[dict], bool], **value: str) -> bool:
        """Become the holder if nobody is, the last entry is free, or its lease has ended."""
        at, last = self.store.latest(self.log)
        if last is not None and not free(last) and not _expired(last):
            return False
        self.at = at
        return self.say(**value)

    def say(self, **value: str) -> bool:
        """Add an entry; False if somebody has taken over."""
        entry = {**value, "owner": self.owner, "at": now(), "expires": _expiry(self.lease)}
        if not self.store.append(self.log, self.at, entry):
            return False
        self.at += 1
        return True


def copy_in(store: Store, batch: Batch) -> dict:
    """Copy the raw files beside their manifest, which is written last and held against the copies."""
    folder = f"bronze/load_type={batch.load_type}/dt={batch.dt}/batch_id={batch.batch_id}"
    files = []
    for entity, path in sorted(batch.files.items()):
        key = f"{folder}/{path.rsplit('/', 1)[-1]}"
        size, sha = store.copy(path, key)
        files.append({"entity": entity, "key": key, "bytes": size, "sha256": sha})
    manifest = {"batch_id": batch.batch_id, "load_type": batch.load_type, "dt": batch.dt, "cutoff_ts": batch.cutoff.isoformat() if batch.cutoff else None, "schema_version": batch.schema_version, "files": files}
    verify(store, manifest)
    store.write_json(f"{folder}/manifest.json", manifest)
    return manifest


def verify(store: Store, manifest: dict) -> None:
    """Every file is what the manifest says."""
    for f in manifest["files"]:
        if store.checksum(f["key"]) != (f["bytes"], f["sha256"]):
            raise GateError(f"{f['key']} is not the file of the manifest")


def gold(store: Store, name: str) -> DataFrame | None:
    pointer = store.latest(POINTER)[1] or {}
    return store.spark.read.parquet(store.path(pointer[name])) if name in pointer else None


def _read(store: Store, manifest: dict, entity: entities.Entity) -> DataFrame:
    (f,) = [f for f in manifest["files"] if f["entity"] == entity.name]
    path, columns = store.path(f["key"]), list(entity.raw)
    if path.endswith(("_json.txt", ".json")):
        return readers.json_array(store.spark, path, columns, ("is_active",))[0]
    return readers.csv_text(store.spark, path, columns)


def _clean(store: Store, batch: Batch, entity: entities.Entity, annotated: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Write accepted rows to silver and rejected ones to quarantine; the annotated plan is computed once."""
    path = store.path(f"work/{batch.batch_id}/{entity.name}")
    annotated.write.mode("overwrite").parquet(path)
    rows = store.spark.read.parquet(path)
    silver = f"silver/{entity.name}/batch_id={batch.batch_id}"
    clean = accepted(rows).select(*entity.clean, "dq_flags", "_src_row")
    sinks.write_parquet(clean, store.path(silver))
    rejects = rejected(rows, entity.name, batch.batch_id, source)
    sinks.write_parquet(rejects, store.path(f"quarantine/{entity.name}/batch_id={batch.batch_id}"))
    read = store.spark.read.parquet
    return read(store.path(silver)), read(store.path(f"quarantine/{entity.name}/batch_id={batch.batch_id}"))


def _publish(store: Store, owner: str, pointer: dict, name: str, df: DataFrame) -> DataFrame:
    pointer[name] = f"gold/{name}/v={owner}"
    sinks.write_parquet(df, store.path(pointer[name]))
    return store.spark.read.parquet(store.path(pointer[name]))


def run(spark: SparkSession, root: str, batch: Batch, lease: float = LEASE, take_over: bool = False) -> str:
    """Load a batch; LOADED, or SKIPPED if it was loaded before.

    Raises BusyError if another batch is being written or this one is held elsewhere; any other failure is recorded as
    FAILED and raised. With `take_over`, locks of runs that are known to be dead are taken before their lease ends.
    """
    store = Store(spark, root)
    owner = f"{batch.batch_id}-{uuid.uuid4().hex[:12]}"
    last = status(store, batch.batch_id)
    if last and last["status"] == "LOADED":
        return "SKIPPED"
    writer, item = Lock(store, WRITER, owner, lease), Lock(store, item_of(batch.batch_id), owner, lease)
    if not writer.take(lambda v: take_over or v["status"] == "FREE", status="HELD", batch_id=batch.batch_id):
        raise BusyError("another batch is being written")
    try:
        if not item.take(lambda v: take_over or v["status"] not in RUNNING, batch_id=batch.batch_id, status="RECEIVED"):
            raise BusyError(f"{batch.batch_id} is held by another run")
        version, pointer = store.latest(POINTER)
        if batch.batch_id in (pointer or {}).get("batches", []):  # killed after its tables were published
            item.say(batch_id=batch.batch_id, status="LOADED")
            return "LOADED"
        try:
            manifest = copy_in(store, batch)
            item.say(batch_id=batch.batch_id, status="VALIDATED")
            item.say(batch_id=batch.batch_id, status="PROCESSING")
            pointer, audit = _load(store, batch, manifest, owner, pointer or {})
            pointer["batches"] = [*pointer.get("batches", []), batch.batch_id]
            if not store.append(POINTER, version, pointer):
                raise BusyError("another batch was published meanwhile")
        except Exception as e:
            item.say(batch_id=batch.batch_id, status="FAILED", error=str(e)[:500])
            raise
        store.write_json(f"control/audit/{batch.batch_id}.json", audit)
        item.say(batch_id=batch.batch_id, status="LOADED")
        return "LOADED"
    finally:
        writer.say(status="FREE", batch_id=batch.batch_id)


def _load(store: Store, batch: Batch, manifest: dict, owner: str, published: dict) -> tuple[dict, dict]:
    """Write all tables of the batch; the pointer that would publish them, and the batch's audit."""
    spark, pointer = store.spark, dict(published)
    name_of = {f["entity"]: f["key"].rsplit("/", 1)[-1] for f in manifest["files"]}
    rejects, counts, changes, dims = [], [], {}, {}
    for entity in (entities.BRANCHES, entities.PRODUCTS, entities.CUSTOMERS):
        table, sk = DIMS[entity.name]
        raw = _read(store, manifest, entity)
        clean, bad = _clean(store, batch, entity, entity.cleanse(raw, batch.as_of), name_of[entity.name])
        hashed = scd2.with_hash(clean, list(entity.business)).withColumn("_order", F.col("_src_row")).drop("_src_row")
        old = gold(store, table)
        if old is None or old.isEmpty():
            new, kinds = scd2.baseline(hashed, sk, "_order"), {}
        else:
            if batch.cutoff is None:
                raise GateError("an incremental batch needs a cutoff")
            kinds = {r.change: r.n for r in scd2.change_counts(old, hashed, entity.key).collect()}
            new = scd2.merge(old, hashed, entity.key, sk, "_order", batch.cutoff)
        dims[entity.name] = _publish(store, owner, pointer, table, new)
        changes |= {f"{entity.name}_{k}": kinds.get(k, 0) for k in ("new", "changed")}
        rejects.append(bad)
        counts.append((entity.name, name_of[entity.name], raw.count(), clean.count(), bad.count()))
    tx = entities.TRANSACTIONS
    raw = _read(store, manifest, tx)
    checks = [("TX-RI-ACCT", "account_id", dims["customers"]), ("TX-RI-PROD", "product_id", dims["products"]), ("TX-RI-BR", "branch_id", dims["branches"])]
    clean, bad = _clean(store, batch, tx, entities.references(tx.cleanse(raw, batch.as_of), checks), name_of["transactions"])
    rejects.append(bad)
    counts.append((tx.name, name_of[tx.name], raw.count(), clean.count(), bad.count()))
    incoming = clean.drop("_src_row")
    for entity, key, sk in (("customers", "account_id", "customer_sk"), ("products", "product_id", "product_sk"), ("branches", "branch_id", "branch_sk")):
        incoming = resolve_sk(incoming, dims[entity], key, key, sk, "timestamp")
    old = gold(store, "fact_transaction")
    if old is None:
        fact, moved = incoming.withColumns({"loaded_batch_id": F.lit(batch.batch_id), "first_batch_id": F.lit(batch.batch_id)}), (counts[-1][3], 0, 0)
    else:
        moved = tuple(facts.summary(old, incoming, "transaction_id", FACT_VALUES).first())
        fact = facts.upsert(old, incoming, "transaction_id", batch.batch_id)
    fact = _publish(store, owner, pointer, "fact_transaction", fact)
    received = spark.createDataFrame([(batch.batch_id, e, s, n) for e, s, n, _, _ in counts], "batch_id string, entity string, source_file string, received long")
    all_rejects = rejects[0].unionByName(rejects[1]).unionByName(rejects[2]).unionByName(rejects[3])
    _gates(spark, batch, counts, all_rejects, received)
    card = quality.scorecard(received, all_rejects)
    old_card = gold(store, "dq_scorecard")
    _publish(store, owner, pointer, "dq_scorecard", card if old_card is None else quality.replace_batch(old_card, card, batch.batch_id))
    row = {"batch_id": batch.batch_id, "fact_inserted": moved[0], "fact_updated": moved[1], "fact_corrected": moved[2], **changes}
    change_schema = "batch_id string, fact_inserted long, fact_updated long, fact_corrected long, customers_new long, customers_changed long, products_changed long, branches_changed long"
    fresh = spark.createDataFrame([tuple(row[c.split()[0]] for c in change_schema.split(", "))], change_schema)
    old_changes = gold(store, "batch_changes")
    _publish(store, owner, pointer, "batch_changes", fresh if old_changes is None else quality.replace_batch(old_changes, fresh, batch.batch_id))
    snap = kpis.snapshots(v_fact(fact), dims["branches"], {batch.batch_id: F.lit(True)})
    old_snap = gold(store, "kpi_snapshot")
    _publish(store, owner, pointer, "kpi_snapshot", snap if old_snap is None else quality.replace_batch(old_snap, snap, batch.batch_id))
    total = quality.control_sum(clean).first()
    results = {e: {"source_file": f, "raw": n, "clean": c, "rejected": r} for e, f, n, c, r in counts}
    audit = {"batch_id": batch.batch_id, "as_of": batch.as_of, "at": now(), "results": results, "changes": row, "clean_rows": total.rows, "clean_amount_inr": int(total.home_amount)}
    return pointer, audit


def _gates(spark: SparkSession, batch: Batch, counts: list[tuple], rejects: DataFrame, received: DataFrame) -> None:
    table = spark.createDataFrame([(e, n, c, r) for e, _, n, c, r in counts], "entity string, raw long, clean long, rejected long")
    wrong = [r.entity for r in quality.reconcile(table).filter("NOT balanced").collect()]
    high = [r.entity for r in quality.quarantine_rate(rejects, received, batch.reject_limit).filter("over_limit").collect()]
    if wrong or high:
        raise GateError(f"rows do not add up: {wrong}; too many rejects: {high}")


def v_fact(fact: DataFrame) -> DataFrame:
    return fact.withColumnRenamed("timestamp", "txn_ts").drop("remarks", "dq_flags")


def star_of(fact: DataFrame, customer: DataFrame, branch: DataFrame, product: DataFrame) -> Star:
    return Star(v_fact(fact), customer, branch, product)


def published(spark: SparkSession, root: str) -> Star:
    """The star as the last loaded batch left it."""
    store = Store(spark, root)
    return star_of(*[gold(store, t) for t in ("fact_transaction", "dim_customer", "dim_branch", "dim_product")])


def indicators(spark: SparkSession, root: str, as_of: str, cutoff: str, before: str, now_batch: str) -> dict[str, DataFrame]:
    """All thirteen over the published tables, in the order in which they are shown."""
    s, store = published(spark, root), Store(spark, root)
    rows = {
        "kpi01": kpis.top_customers(s), "kpi02": kpis.branch_trend(s), "kpi03": kpis.product_revenue(s), "kpi04": kpis.dormant_accounts(s, as_of), "kpi05": kpis.suspicious(s.fact),
        "kpi06": kpis.rfm_segments(s, as_of), "kpi07": kpis.branch_rank(s), "kpi08": kpis.kyc_exposure(s), "kpi09": kpis.refund_rate(s), "kpi10": kpis.scorecard_rates(gold(store, "dq_scorecard")),
        "kpi11": kpis.reconciliation(gold(store, "batch_changes"), gold(store, "kpi_snapshot")), "kpi12": kpis.kyc_transitions(s.customer), "kpi13": kpis.activation(s.fact, s.customer, before, now_batch, cutoff),
    }
    return {k: kpis.in_order(k, v) for k, v in rows.items()}
