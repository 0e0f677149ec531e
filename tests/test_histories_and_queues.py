"""Presence histories, the queue machine, dictionaries, the stage ledger and published pairs against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import entities, presence_history as ph
from shelfwise.operators.stages import ChangedFacts, Ledger, Stage, table_digest
from shelfwise.sources.publish import Publication, PublishFault
from shelfwise.streaming import queue

SEED, SOURCE = "sku string, day date, value string", "source string, position int, first_day date, last_day date, absence_capable boolean, complete boolean"
RUN, SEEN = "run_id string, day date, status string, qa string, dry boolean, observation_count long", "run_id string, sku string, day date, presence_state string, observation_complete boolean, absence_capable boolean"


def day(n, month=1):
    return dt.date(2026, month, n)


def history(spark, seed=(), seed_ok=(True, True), sources=(), cells=(), runs=(), seen=(), **more):
    frame = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    rows, faults = ph.presence_history(frame(seed, SEED), frame([seed_ok], "absence_capable boolean, complete boolean"), frame(sources, SOURCE), frame(cells, "source string, sku string, day date, value string"), frame(runs, RUN), frame(seen, SEEN), **more)
    return {(r["sku"], r["day"]): r["value"] for r in rows.collect()}, {(r["code"], r["day"], r["sku"], r["source"]) for r in faults.collect()}, (rows, faults)


def test_absence_only_where_it_could_be_seen(spark):
    sources = [("full", 1, day(1), day(1), True, True), ("part", 2, day(2), day(2), False, True), ("broken", 3, day(3), day(3), True, False)]
    cells = [("full", "A", day(1), None), ("part", "B", day(2), "1"), ("broken", "A", day(3), "UNKNOWN"), ("part", "C", day(2), "0"), ("full", "A", day(9), "1")]
    got, faults, _ = history(spark, sources=sources, cells=cells)
    assert got == {("A", day(1)): "1", ("B", day(1)): "0", ("A", day(2)): "UNKNOWN", ("B", day(2)): "1", ("A", day(3)): "UNKNOWN", ("B", day(3)): "UNKNOWN"} and not faults


def test_seed_before_dated_before_committed(spark):
    seed = [("A", day(1), "1"), ("A", day(2), "0"), ("Z", day(2), "UNKNOWN")]
    sources = [("s", 2, day(2), day(4), True, True), ("first", 1, day(4), day(4), False, True)]
    cells = [("s", "A", day(2), "1"), ("s", "B", day(3), "1"), ("s", "B", day(4), "1"), ("first", "A", day(4), "1")]
    runs = [("old", day(1), "COMMITTED", "PASS", False, 1), ("r4", day(4), "COMMITTED", "PASS", False, 1), ("r5", day(5), "COMMITTED", "PASS", False, 2), ("dry", day(6), "COMMITTED", "PASS", True, 1), ("late", day(8), "COMMITTED", "PASS", False, 1)]
    seen = [("r5", "A", day(5), "ABSENT", True, True), ("r5", "B", day(5), "PRESENT", True, True), ("r4", "Q", day(4), "PRESENT", True, True), ("late", "A", day(8), "PRESENT", True, True)]
    got, faults, frames = history(spark, seed, sources=sources, cells=cells, runs=runs, seen=seen, last_day="2026-01-07")
    assert not faults
    assert {k: v for k, v in got.items() if k[0] == "A"} == {("A", day(1)): "1", ("A", day(2)): "0", ("A", day(3)): "0", ("A", day(4)): "1", ("A", day(5)): "0"}
    assert {k: v for k, v in got.items() if k[0] == "B"} == {("B", day(1)): "UNKNOWN", ("B", day(2)): "UNKNOWN", ("B", day(3)): "1", ("B", day(4)): "UNKNOWN", ("B", day(5)): "1"}
    assert {s for s, _ in got} == {"A", "B", "Z"}
    assert ph.checked(frames).count() == len(got)
    spans = {r["sku"]: (r["first_seen"], r["last_seen"], r["days_present"], r["days_unknown"]) for r in ph.presence_spans(frames[0]).collect()}
    assert spans["A"] == (day(1), day(4), 2, 0) and spans["B"] == (day(3), day(5), 2, 3)
    away = {(r["sku"], r["first_day"], r["last_day"], r["days"]) for r in ph.absences(frames[0]).collect()}
    assert ("A", day(2), day(3), 2) in away and ("A", day(5), day(5), 1) in away and not any(s == "B" for s, *_ in away)


def test_excluded_months_bring_no_product(spark):
    seed = [("A", day(1), "1"), ("A", day(1, 2), "0"), ("B", day(1), "1"), ("B", day(1, 2), "1"), ("C", day(1), "0"), ("C", day(1, 2), "0"), ("D", day(1), "1")]
    sources = [("x", 1, day(5), day(5), True, True), ("y", 2, day(5, 2), day(5, 2), True, True)]
    got, faults, _ = history(spark, seed, sources=sources, cells=[("x", "E", day(5), "1"), ("y", "F", day(5, 2), None)], months=["2026-01"])
    assert got == {("B", day(1, 2)): "1", ("C", day(1, 2)): "0", ("F", day(1, 2)): "UNKNOWN", ("B", day(5, 2)): "0", ("C", day(5, 2)): "0", ("F", day(5, 2)): "1"} and not faults


def test_contradictions_are_errors(spark):
    sources = [("s", 1, day(1), day(1), True, True)]
    runs = [("a", day(2), "COMMITTED", "PASS", False, 1), ("b", day(2), "COMMITTED", "PASS", False, 1), ("c", day(3), "COMMITTED", "PASS", False, 2), ("d", day(4), "COMMITTED", "PASS", False, 1)]
    seen = [("a", "A", day(2), "PRESENT", True, True), ("b", "A", day(2), "PRESENT", True, True), ("c", "A", day(3), "PRESENT", True, True), ("d", "A", day(4), "PRESENT", True, None)]
    _, faults, frames = history(spark, sources=sources, cells=[("s", "A", day(1), "1"), ("s", "A", day(1), "0")], runs=runs, seen=seen)
    assert faults == {("HISTORY_SOURCE_PRESENCE_CONFLICT", day(1), "A", "s"), ("HISTORY_MULTIPLE_COMMITTED_RUNS", day(2), None, "b"), ("HISTORY_RUN_OBSERVATIONS_INCOMPLETE", day(3), None, "c"), ("HISTORY_RUN_OBSERVATIONS_INCOMPLETE", day(4), None, "d")}
    with pytest.raises(ph.HistoryFaults, match="HISTORY_MULTIPLE_COMMITTED_RUNS"):
        ph.checked(frames)
    assert history(spark)[0] == {}


def plain_queue(actions, minutes, retries, end):
    states = {}
    for unit, at, seq, action, reason in sorted(actions, key=lambda a: (a[1], a[2])):
        state = states.get(unit)
        if state and state[0] == "CLAIMED" and at > state[2] + dt.timedelta(minutes=minutes):
            state = ["RETRY", state[1], None, queue.STALE]
        if state is None:
            state = ["PENDING", 0, None, None] if action == "INGEST" else None
        elif action == "CLAIM" and state[0] in ("PENDING", "RETRY"):
            state = ["CLAIMED", state[1], at, None]
        elif state[0] == "CLAIMED" and action == "COMPLETE":
            state = ["COMPLETED", state[1], None, None]
        elif state[0] == "CLAIMED" and action == "FAIL":
            state = ["RETRY" if state[1] < retries else "FAILED", state[1] + 1, None, reason]
        elif state[0] == "CLAIMED" and action == "BLOCK":
            state = ["BLOCKED", state[1], None, reason]
        elif state[0] == "BLOCKED" and action == "REQUEUE":
            state = ["RETRY", state[1], None, reason]
        if state:
            states[unit] = state
    for state in states.values():
        if state[0] == "CLAIMED" and end > state[2] + dt.timedelta(minutes=minutes):
            state[:] = ["RETRY", state[1], None, queue.STALE]
    return {u: (s[0], s[1], s[3]) for u, s in states.items()}


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("files", [1, 4])
def test_queue_states_do_not_depend_on_batches(spark, rocks, tmp_path, files):
    rng, begin = random.Random(8), dt.datetime(2026, 1, 1)
    kinds = ["INGEST", "CLAIM", "CLAIM", "COMPLETE", "FAIL", "BLOCK", "REQUEUE"]
    actions = [(f"u{rng.randint(0, 7)}", begin + dt.timedelta(minutes=4 * k + rng.randint(0, 3)), k, rng.choice(kinds), f"r{k}") for k in range(160)]
    actions = [(f"u{k}", begin, -1, "INGEST", None) for k in range(6)] + actions
    schema = "unit string, at timestamp, seq long, action string, reason string"
    share = -(-len(actions) // files)
    for k in range(files):
        spark.createDataFrame(actions[k * share : (k + 1) * share], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    log = queue.transitions(stream, 15, 2)
    log.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    got = {r["unit"]: (r["status"], r["attempts"], r["reason"]) for r in queue.latest_states(out).collect()}
    assert got == plain_queue(actions, 15, 2, max(a[1] for a in actions))
    assert out.where("action <> 'EXPIRE'").count() == len(actions)
    assert out.where("action = 'INGEST' AND changed").groupBy("unit").count().where("count > 1").count() == 0
    assert any(s[2] == queue.STALE for s in got.values()) or out.where("action = 'EXPIRE'").count() > 0


def test_connected_names(spark):
    rng = random.Random(6)
    pairs = [(f"n{rng.randint(0, 300):03d}", f"k{rng.randint(0, 260)}") for _ in range(300)]
    chain = [(f"c{k:03d}", f"s{k // 2}") for k in range(80)] + [(f"c{k:03d}", f"t{(k + 1) // 2}") for k in range(80)]
    hub = [(f"h{k:03d}", "hub") for k in range(100)]
    rows = pairs + chain + hub + [(None, "k1"), ("alone", None), ("solo", "only")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for node, key in rows:
        if node is not None and key is not None:
            parent[root(node)] = root(("key", key))
    least = {}
    for node, key in rows:
        if node is not None:
            r = root(node)
            least[r] = min(least.get(r, node), node)
    got = {r["node"]: r["root"] for r in entities.connected(spark.createDataFrame(rows, "node string, key string"), "node", "key").collect()}
    assert got == {node: least[root(node)] for node, _ in rows if node is not None}
    assert entities.connected(spark.createDataFrame([], "node string, key string"), "node", "key").count() == 0


def test_brand_classes_keep_what_persons_made(spark):
    auto = entities.AUTOMATIC
    existing = [("acme", "Acme", "ACME inc|", "HUMAN", "OK"), ("acme inc", "acme  INC", "", auto, "X"), ("zeta", "Zeta", "zz", auto, "X"), ("zz", "ZZ", "", auto, "X"), (" ", "blank", "", auto, "X"), ("acme co", "Acme", None, "HUMAN", "OK")]
    products = [("Nova",), ("NOVA",), ("Nova",), ("zz ",), (None,), ("",), ("Acme Inc",)]
    got = entities.reconciled_brands(spark.createDataFrame(existing, "brand_id string, canonical_name string, aliases string, confidence string, review_status string"), spark.createDataFrame(products, "brand_id string"))
    assert {(r["brand_id"], r["review_status"]) for r in got.collect()} == {("acme", "OK"), ("acme co", "OK"), ("zeta", "X"), ("Nova", "NEEDS_HUMAN_REVIEW")}


def test_a_ledger_restarts_where_inputs_or_code_changed(spark, tmp_path):
    numbers = spark.range(10).withColumnRenamed("id", "x")
    stages = [Stage("big", ("numbers",), lambda t: t.where("x > 3")), Stage("sum", ("big",), lambda t: t.agg(F.sum("x").alias("s"))), Stage("aside", ("numbers",), lambda t: t.limit(0))]
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    assert ledger.run("one", {"numbers": numbers}, stages)["sum"].first()["s"] == 39 and ledger.ran == ["big", "sum", "aside"]
    assert Ledger(spark, ledger.folder).run("two", {"numbers": numbers.repartition(3)}, stages)["sum"].first()["s"] == 39
    again = Ledger(spark, ledger.folder)
    again.run("three", {"numbers": numbers}, stages)
    assert again.ran == []
    changed = [stages[0], Stage("sum", ("big",), lambda t: t.agg(F.sum(F.col("x") + 1).alias("s"))), stages[2]]
    assert again.run("three", {"numbers": numbers}, changed)["sum"].first()["s"] == 45 and again.ran == ["sum"]
    with pytest.raises(ChangedFacts, match="numbers"):
        again.run("three", {"numbers": spark.range(11).withColumnRenamed("id", "x")}, stages)
    # other numbers, of which the same are big: the last stage is not built again
    assert again.run("four", {"numbers": numbers.where("x <> 2")}, stages)["sum"].first()["s"] == 39 and again.ran == ["big", "aside"]
    with pytest.raises(ValueError, match="needs big"):
        again.run("five", {"numbers": numbers}, [stages[1]])


def test_a_stage_that_dies_leaves_no_entry_and_changed_outputs_are_refused(spark, tmp_path):
    numbers = spark.range(4).withColumnRenamed("id", "x")
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    broken = Stage("out", ("numbers",), lambda t: t.select(F.raise_error(F.lit("no")).alias("x")), version="1")
    with pytest.raises(Exception, match="no"):
        ledger.run("one", {"numbers": numbers}, [broken])
    whole = Stage("out", ("numbers",), lambda t: t.select("x"), version="1")
    assert ledger.run("one", {"numbers": numbers}, [whole])["out"].count() == 4 and ledger.ran == ["out"]
    place = next((tmp_path / "ledger" / "out").iterdir())
    spark.range(9).withColumnRenamed("id", "x").write.mode("append").parquet(str(place))
    with pytest.raises(ChangedFacts, match="output of out"):
        ledger.run("one", {"numbers": numbers}, [whole])
    assert table_digest(numbers) == table_digest(numbers.orderBy(F.desc("x"))) != table_digest(numbers.union(numbers))


class Dies(Publication):
    """Breaks off before its n-th move, and does not clean up if it is `sudden`."""

    def __init__(self, *args, at: int, sudden: bool):
        super().__init__(*args)
        self.left, self.sudden, self.dead = at, sudden, False

    def move(self, source, target):
        self.left -= 1
        if self.left == -1:
            self.dead = True
            raise KeyboardInterrupt if self.sudden else OSError("no space")
        super().move(source, target)

    def recover(self):
        return False if self.sudden and self.dead else super().recover()


@pytest.mark.parametrize("sudden", [False, True])
@pytest.mark.parametrize("before", [False, True])
def test_a_pair_is_old_or_new_after_any_fault(spark, tmp_path, before, sudden):
    old, new = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    for at in range(6):
        folder = f"file://{tmp_path}/{at}"
        if before:
            Publication(spark, folder, "rows").publish(old, {"edition": 1})
        try:
            Dies(spark, folder, "rows", at=at, sudden=sudden).publish(new, {"edition": 2})
        except (KeyboardInterrupt, OSError):
            done = False
        else:
            done = True
        pair = Publication(spark, folder, "rows")
        if sudden and pair.there(pair.journal):
            with pytest.raises(PublishFault):
                pair.read()
            with pytest.raises(PublishFault):
                pair.publish(new, {})
        pair.recover()
        assert done == (at >= (5 if before else 3))
        if before or done:
            rows, manifest = pair.read()
            assert (rows.count(), manifest["edition"]) == ((5, 2) if done else (3, 1))
        else:
            assert not any(pair.there(t) for t in pair.targets)
        assert not pair.recover()


def test_a_manifest_of_another_table_is_refused(spark, tmp_path):
    pair = Publication(spark, f"file://{tmp_path}", "rows")
    with pytest.raises(PublishFault, match="another table"):
        pair.publish(spark.range(3), {"digest": "x"})
    assert not pair.there(pair.targets[0])
