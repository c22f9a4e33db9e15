"""Operators on small frames: brute force, hot groups, ties, missing keys, empty input."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import arrears as ar
from ledgerloom.operators import decisions as dec
from ledgerloom.operators import joins, ledgers, loading, models, quality, reports, routing
from ledgerloom.operators.history import prior_percentile, prior_rate, prior_rates, trailing_count
from ledgerloom.operators.metrics import ranking_metrics
from ledgerloom.operators.ordered import dense_rank_of, next_at, prefix_sums, running_sum, with_position
from ledgerloom.operators.splits import date_folds
from ledgerloom.session import new_path
from ledgerloom.sources.files import REQUIRED, read_json_documents, read_optional, resolve_columns
from ledgerloom.sources.jdbc import jdbc_options
from ledgerloom.sources.schemas import PROMISES
from ledgerloom.sources.sinks import insert_if_absent

DAY = datetime.date(2025, 1, 1)


def day(i):
    return DAY + datetime.timedelta(days=i)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- history -----------------------------------------------------------------------------------

def history(spark, label=1):
    data = [("C1", "BK-001", day(1), label), ("C2", "BK-001", day(1), 0), ("C3", "BK-001", day(2), 0), ("C4", "BK-002", day(1), 0), ("C5", None, day(3), 1)]
    return spark.createDataFrame(data, "id string, broker_id string, arrived_on date, delayed int")


def test_prior_rate_sees_earlier_days_only(spark):
    out = {r["id"]: (r["n"], r["rate"]) for r in prior_rate(history(spark), "broker_id", "arrived_on", "delayed", "n", "rate").collect()}
    assert out == {"C1": (0, None), "C2": (0, None), "C3": (2, 0.5), "C4": (0, None), "C5": (None, None)}


def test_own_label_does_not_reach_own_feature(spark):
    def c1(label):
        return prior_rate(history(spark, label), "broker_id", "arrived_on", "delayed", "n", "rate").filter("id = 'C1'").select("n", "rate").first()

    assert c1(0) == c1(1)


def test_prior_rates_of_small_groups_need_no_join(spark, monkeypatch):
    """Small groups are windows over the rows, large ones day totals joined to them; both give the same, NULL keys and days included."""
    import ledgerloom.operators.history as h

    r = random.Random(8)
    data = [(i, r.choice(["a", "b", None]), r.choice([*range(9), None]), r.choice([day(x) for x in range(6)] + [None]), r.choice([0, 1, 1, None])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, broker string, importer int, d date, y int")
    groups = {"importer": ("ni", "ri"), "broker": ("nb", "rb")}

    def run():
        out = prior_rates(df, groups, "d", "y", df)
        return out._jdf.queryExecution().optimizedPlan().toString(), {x["id"]: (x["ni"], x["ri"], x["nb"], x["rb"]) for x in out.collect()}

    plan, small = run()
    monkeypatch.setattr(h, "_WINDOW_ROWS", 10)
    joined, large = run()
    assert "Join" not in plan and "Join" in joined and small == large
    for i, b, _, d, _ in data:
        seen = [y for _, c, _, e, y in data if c == b and y is not None and (e is None or e < d)] if b and d else None
        assert small[i][2:] == ((None, None) if seen is None else (len(seen), sum(seen) / len(seen) if seen else None))


def test_trailing_count(spark):
    df = spark.createDataFrame([(i, day(x)) for i, x in enumerate([0, 0, 1, 8, 9, 30])], "id int, d date")
    out = {r["id"]: (r["same"], r["week"]) for r in trailing_count(df, "d", 7, "same", "week").collect()}
    assert out == {0: (2, 0), 1: (2, 0), 2: (1, 2), 3: (1, 1), 4: (1, 1), 5: (1, 0)}


def test_prior_percentile_known_values(spark):
    df = spark.createDataFrame([(1, 10, day(1), 10.0), (2, 10, day(1), 30.0), (3, 10, day(2), 20.0)], "id int, g int, d date, v double")
    assert rows(prior_percentile(df, "g", "d", "v", "p").fillna(-1.0), "id", "p") == [(1, -1.0), (2, -1.0), (3, 0.5)]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_prior_percentile_joins_few_cells_without_a_shuffle(spark, monkeypatch, most):
    import ledgerloom.operators.history as h

    monkeypatch.setattr(h, "_BROADCAST_CELLS", most)
    data = [(1, "a", day(1), 10.0), (2, "a", day(1), 30.0), (3, "a", day(2), 20.0), (4, None, day(2), 1.0), (5, "a", day(3), None)]
    out = prior_percentile(spark.createDataFrame(data, "id int, g string, d date, v double"), "g", "d", "v", "p")
    assert {x["id"]: x["p"] for x in out.collect()} == {1: None, 2: None, 3: 0.5, 4: None, 5: None}
    assert ("strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString().split("\n")[1]) == (most > 0)


@pytest.mark.parametrize("block_bits", [3, 6, 16])
def test_prior_percentile_equals_brute_force(spark, monkeypatch, block_bits):
    """One group holds most rows; ties, NULL values and NULL groups included."""
    import ledgerloom.operators.history as h

    monkeypatch.setattr(h, "_BLOCK_BITS", block_bits)
    r = random.Random(block_bits)
    data = [(i, "hot" if r.random() < 0.7 else r.choice(["a", "b", None]), day(r.randrange(12)), None if r.random() < 0.05 else float(r.randrange(25))) for i in range(600)]
    got = {x["id"]: x["p"] for x in prior_percentile(spark.createDataFrame(data, "id int, g string, d date, v double"), "g", "d", "v", "p").collect()}
    for i, g, d, v in data:
        seen = [w for _, h2, e, w in data if h2 == g and e < d and w is not None] if g is not None and v is not None else []
        assert got[i] == (sum(w < v for w in seen) / len(seen) if seen else None)


# ---- global order ------------------------------------------------------------------------------

def numbers(spark, n=300, seed=3):
    r = random.Random(seed)
    return [(i, "hot" if r.random() < 0.6 else r.choice("abc"), r.randrange(50)) for i in range(n)]


def test_positions_and_prefix_sums(spark):
    data = numbers(spark)
    df = spark.createDataFrame(data, "id int, g string, v int")
    order = [F.col("v").desc(), F.col("id")]
    want = sorted(data, key=lambda x: (-x[2], x[0]))
    assert [x["id"] for x in with_position(df, order).orderBy("position").collect()] == [x[0] for x in want]
    got = {x["id"]: x["s"] for x in prefix_sums(df, order, {"s": F.col("v")}).collect()}
    total = 0
    for i, _, v in want:
        total += v
        assert got[i] == total


def test_running_sum_of_a_hot_group(spark):
    data = numbers(spark)
    got = {x["id"]: x["s"] for x in running_sum(spark.createDataFrame(data, "id int, g string, v int"), ["g"], [F.col("id")], "v", "s").collect()}
    seen = {}
    for i, g, v in data:
        seen[g] = seen.get(g, 0) + v
        assert got[i] == seen[g]


def test_dense_rank_and_next_at(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, v int")
    assert rows(dense_rank_of(df, "v", "r"), "k", "r") == [("a", 2), ("b", 1), ("c", 2), ("d", 3)]
    r = random.Random(5)
    left = [(i, r.choice("hhhab"), r.randrange(100)) for i in range(120)]
    right = [(r.choice("hhhac"), r.randrange(100)) for _ in range(80)]
    out = next_at(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, u int"), "k", "t", "u", "nxt")
    got = {x["id"]: x["nxt"] for x in out.collect()}
    for i, k, t in left:
        later = [u for q, u in right if q == k and u >= t]
        assert got[i] == (min(later) if later else None)


# ---- joins and quality -------------------------------------------------------------------------

def test_outer_joins_keep_unmatched_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 40)], "k int, b int")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    for ours, how in ((joins.left_outer, "left"), (joins.full_outer, "full")):
        got = sorted((tuple(r) for r in ours(a, b, "k").select("k", "a", "b").collect()), key=key)
        assert got == sorted((tuple(r) for r in a.join(b, "k", how).select("k", "a", "b").collect()), key=key)


def test_join_checked_and_compare(spark):
    one = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, w double")
    with pytest.raises(ValueError, match="not unique"):
        joins.join_checked(one, twice, "k")
    assert joins.join_checked(one, twice, "k", validate="one_to_many").count() == 2
    other = spark.createDataFrame([(1, 1.00001), (3, 2.0)], "k int, v double")
    assert rows(joins.compare_frames(one, other, ["k"], 0.001), "k", "column") == [(2, "v"), (3, "v")]
    assert joins.fanout_report(one, twice, "k").first().asDict() == {"left_rows": 2, "right_rows": 2, "joined_rows": 2, "max_matches": 2}


def test_null_key_is_missing(spark):
    df = spark.createDataFrame([("A1",), (None,), ("A9",)], "vessel string")
    known = spark.createDataFrame([("A1",), (None,)], "vessel string")
    assert rows(joins.flag_missing(df, known, "vessel", "gone").fillna("-"), "vessel", "gone") == [("-", True), ("A1", False), ("A9", True)]
    assert quality.keep_known(df, "vessel", known).count() == 1


def test_missing_rows_and_rules(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, None)], "a double, b double")
    assert quality.drop_missing(df, "a").count() == 2 and quality.drop_missing(df, ["a", "b"]).count() == 1
    tagged = quality.tag_first_failure(df, [("no_a", F.col("a").isNull()), ("big", F.col("b") > 1)])
    assert dict(rows(quality.reject_counts(tagged), "rule", "n_rows")) == {"loaded": 2, "no_a": 1}


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 5, "c")], "k string, o int, v string")
    assert rows(quality.first_per_key(df, "k", ["o"], "n"), "k", "v", "n") == [("j", "c", 1), ("k", "a", 2)]
    assert rows(quality.last_per_key(df, "k", ["o"]), "k", "v") == [("j", "c"), ("k", "b")]


def test_strict_parsing_names_bad_values(spark):
    raw = spark.createDataFrame([("c1", "maybe")], "id string, flag string")
    with pytest.raises(ValueError, match="maybe"):
        loading.strict(raw.withColumn("flag", F.lit(None).cast("boolean")), raw, "id", ["flag"])
    with pytest.raises(ValueError, match="maybe"):
        quality.require_parsed(raw.withColumn("p", F.lit(None).cast("int")), "flag", "p")


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 0.5, 0.1), (2, 70000, 1.5, 0.2)], "a bigint, b bigint, c double, d double")
    assert dict(quality.narrow_types(df).dtypes) == {"a": "tinyint", "b": "int", "c": "float", "d": "double"}


# ---- sources -----------------------------------------------------------------------------------

def test_load_twice(spark):
    df = spark.createDataFrame([("A1", "Test Agent"), ("A1", "copy")], "agent_id string, agent_name string")
    path = new_path(spark, "t")
    assert [insert_if_absent(spark, path, df, "agent_id", ["agent_name"], df.columns) for _ in range(2)] == [1, 0]


def test_resolve_columns(spark):
    df = spark.createDataFrame([("7", "x")], "`ACCOUNT_ID ` string, Paid string")
    spec = {"account": (["sk_id_curr", "account_id"], "bigint", REQUIRED), "amount": (["amount", "paid"], "double", -1.0), "age": (["age"], "int", 45)}
    assert resolve_columns(df, spec, case_insensitive=True).first().asDict() == {"account": 7, "amount": -1.0, "age": 45}
    with pytest.raises(ValueError, match="none of"):
        resolve_columns(df, {"z": (["zz"], "int", REQUIRED)})


def test_missing_sources(spark):
    assert read_optional(spark, new_path(spark, "nothing"), "a int") is None
    assert read_json_documents(spark, new_path(spark, "nothing"), PROMISES).count() == 0


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://db/x", "agents", "u", "p")
    assert o["driver"] == "org.postgresql.Driver" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:other://x", "t")


def test_full_outer_reads_the_many_side_past_a_table_of_the_other(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    many = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 0)], "k int, y int")
    out = joins.full_outer(one, many, "k")
    assert out.columns == ["k", "x", "y"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([(1, "a", 10), (1, "a", 11), (2, "b", None), (None, "n", None), (3, None, 30), (None, None, 0)], key=str)
    plan = joins.full_outer(one, many, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=shuffle_hash") == 2 and plan.count("Aggregate") == 1


# ---- arrears -----------------------------------------------------------------------------------

INST = "SK_ID_CURR bigint, SK_ID_PREV bigint, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int, AMT_INSTALMENT decimal(18,2), AMT_PAYMENT decimal(18,2)"


def inst(spark, data):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:5], Decimal(r[5]), None if r[6] is None else Decimal(r[6])) for r in data], INST)


def test_arrears_events(spark):
    df = inst(spark, [
        (1, 10, 1, 0, 0, "100", "100"), (1, 10, 2, 30, 50, "100", "100"), (2, 20, 1, 0, None, "100", None),
        (3, 30, 1, 0, 0, "100", "90"), (4, 40, 1, 0, 14, "100", "100"), (5, 50, 1, 0, 20, "0", "0"), (6, 60, 1, 0, -3, "100", "50")])
    out = {r["SK_ID_CURR"]: (r["observation_day"], r["recovered"], r["days_to_cure"]) for r in ar.arrears_events(df).collect()}
    assert out == {1: (45, 1, 5), 2: (15, 0, None), 3: (15, 0, None)}


@pytest.mark.parametrize("as_of", ["known", "due"])
def test_history_of_small_loans_shuffles_the_rows_once(spark, monkeypatch, as_of):
    """Rows summed where they meet their event give what cells of days give; NULL days, payments and ties included."""
    r = random.Random(17)
    data = [(c, c * 10 + r.randrange(2), r.randrange(1, 5), r.choice([0, 30, 60, None]), r.choice([-5, 0, 20, 50, 90, None]), r.choice(["100", "250", "0"]), r.choice(["100", "50", None]))
            for c in range(1, 13) for _ in range(9)]
    df = inst(spark, data).withColumn("tie", F.when(F.rand(3) > 0.1, F.monotonically_increasing_id())).localCheckpoint()
    ev = ar.arrears_events(df, ["tie"]).localCheckpoint()

    def run():
        out = ar.repayment_history(ev, df, as_of, ["tie"])
        return out._jdf.queryExecution().optimizedPlan().toString(), sorted(out.collect(), key=lambda x: (x["SK_ID_CURR"], x["SK_ID_PREV"]))

    plan, small = run()
    monkeypatch.setattr(ar, "_LOAN_ROWS", 1)
    cells, large = run()
    assert small == large and len(small) == ev.count() > 10
    assert plan.count("Join ") == 1 < cells.count("Join ")


@pytest.mark.parametrize("as_of", ["known", "due"])
def test_events_and_history_in_one_shuffle(spark, as_of):
    """Events found by a window have the history that events joined to their instalments have; NULL keys have none."""
    r = random.Random(19)
    data = [(r.choice([c, c, c, None]), c * 10 + r.randrange(2), r.randrange(1, 5), r.choice([0, 30, 60, None]), r.choice([-5, 0, 20, 50, 90, None]), r.choice(["100", "250", "0"]), r.choice(["100", "50", None]))
            for c in range(1, 13) for _ in range(9)]
    df = inst(spark, data).withColumn("tie", F.when(F.rand(3) > 0.1, F.monotonically_increasing_id())).localCheckpoint()
    out, want = ar.events_with_history(df, as_of, ["tie"]), ar.repayment_history(ar.arrears_events(df, ["tie"]), df, as_of, ["tie"])
    key = lambda x: (x["SK_ID_CURR"] or 0, x["SK_ID_PREV"])
    assert out.columns == want.columns and sorted(out.collect(), key=key) == sorted(want.collect(), key=key)
    assert any(x["SK_ID_CURR"] is None for x in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_loans_of_very_many_instalments_go_by_cells(spark, monkeypatch):
    from ledgerloom.plans import arrears as plans
    from ledgerloom.plans import tables as t

    folder = "/root/testdata/sf0.001"
    largest = t.instalments(spark, folder).groupBy(*ar.LOAN).count().agg(F.max("count")).first()[0]
    assert largest <= plans.most_instalments(spark, folder) < 1 << 20
    small = plans.history(spark, folder)
    monkeypatch.setattr(ar, "_LOAN_ROWS", 1)
    cells = plans.history(spark, folder)
    assert set(small.columns) == set(cells.columns) and small.count() > 100
    assert small.exceptAll(cells.select(small.columns)).isEmpty() and cells.select(small.columns).exceptAll(small).isEmpty()


def test_history_known_hides_the_event_and_later_payments(spark):
    df = inst(spark, [(1, 10, 1, 0, 20, "100", "100"), (1, 10, 2, 30, 200, "100", "100"), (1, 10, 3, 60, None, "100", None)])
    ev = ar.arrears_events(df)
    known = ar.repayment_history(ev, df, "known").first()
    due = ar.repayment_history(ev, df, "due").first()
    assert (known["prior_instalments_count"], known["prior_late_count"], known["prior_max_days_late"]) == (2, 1, 20.0)
    assert known["prior_payment_ratio"] == 0.5 and known["prior_underpaid_count"] == 1
    assert (due["prior_instalments_count"], due["prior_late_count"], due["prior_max_days_late"]) == (3, 2, 170.0)


def test_no_feature_is_known_only_after_contact():
    quality.assert_no_columns(ar.FEATURE_COLUMNS, ar.FORBIDDEN_POST_CONTACT)
    with pytest.raises(ValueError):
        quality.assert_no_columns([*ar.FEATURE_COLUMNS, "recovered"], ar.FORBIDDEN_POST_CONTACT)


# ---- decisions ---------------------------------------------------------------------------------

def test_segments(spark):
    df = spark.createDataFrame([(0.85,), (0.40,), (0.02,), (0.15,)], "p double")
    assert [r[0].split(" ")[0] for r in df.select(dec.segment(F.col("p"))).collect()] == ["Self-Curer", "Persuadable", "Lost", "Moderate"]


def test_route_savings(spark):
    df = spark.createDataFrame([("o", "FIELD_VISIT", f"z{i % 3}") for i in range(6)] + [("q", "SMS", "z1")], "assigned_officer string, recommended_channel string, zone string")
    out = {r["assigned_officer"]: r for r in dec.route_savings(df).collect()}
    assert (out["o"]["unclustered_km"], out["o"]["clustered_km"], out["o"]["km_saved"], out["o"]["pct_distance_saved"]) == (39.0, 21.0, 18.0, 46.2)
    assert out["q"]["n_field_visits"] == 0 and out["q"]["km_saved"] == 0


def test_repayment_plan(spark):
    plan = dec.repayment_plan(F.lit(75000.0))
    assert spark.range(1).select(*[c.alias(k) for k, c in plan.items()]).first().asDict() == {"daily_payment_fcfa": 2500.0, "weekly_subtotal_fcfa": 17500.0}


def test_adaptation_direction(spark):
    df = spark.createDataFrame([(1, 0.3), (2, 0.3)], "SK_ID_CURR bigint, p double")
    fb = spark.createDataFrame([(1, 0.40), (2, -0.35)], "SK_ID_CURR bigint, feedback_delta double")
    base = dec.adapt_probability(df, "p", "Civil Servant").agg(F.avg("adapted_probability")).first()[0]
    assert base > 0.3
    got = dict(rows(dec.adapt_probability(df, "p", feedback=fb), "SK_ID_CURR", "adapted_probability"))
    assert got[1] == pytest.approx(0.7) and got[2] == 0.01


def test_reconcile_in_order_with_overpayment(spark):
    from decimal import Decimal

    bal = spark.createDataFrame([(1, Decimal(100)), (2, Decimal(50))], "account_id bigint, balance_due decimal(38,2)")
    pay = spark.createDataFrame([(1, "40", 1, 1), (1, "bad", 2, 2), (1, "-5", 3, 3), (1, "80", 4, 4), (1, "10", 5, 5), (9, "10", 1, 6)],
                                "account_id bigint, amount string, paid_at int, payment_id bigint")
    out = [(r["payment_id"], float(r["due_before"]), float(r["due_after"]), r["outcome"]) for r in dec.reconcile(bal, pay).orderBy("payment_id").collect()]
    assert out == [(1, 100.0, 60.0, "PARTIAL_PAYMENT"), (4, 60.0, 0.0, "PAID_IN_FULL"), (5, 0.0, 0.0, "PAID_IN_FULL")]


def test_auto_break_and_reminders(spark):
    df = spark.createDataFrame([("a", "PENDING", day(1)), ("b", "PENDING", day(5)), ("c", "KEPT", day(1))], "promise_id string, status string, promise_date date")
    assert rows(ledgers.auto_break(df, str(day(5))), "promise_id", "status") == [("a", "BROKEN"), ("b", "PENDING"), ("c", "KEPT")]
    assert rows(ledgers.reminders_due(df, str(day(4)), 1), "promise_id") == [("b",)]


def test_account_lookup(spark):
    df = spark.createDataFrame([(5, 1), (5, 2), (9, 3)], "SK_ID_CURR bigint, SK_ID_PREV bigint")
    assert rows(reports.account_lookup(df, 9), "SK_ID_CURR", "found") == [(9, True)]
    assert rows(reports.account_lookup(df, 7), "SK_ID_CURR", "found") == [(5, False)]


def test_routing_order(spark):
    df = spark.createDataFrame([("Check client 103380",), ("who to call today?",), ("total debt",), ("is it legal",), ("send sms",), ("ok",), ("98765",), ("good morning all",)], "t string")
    assert [r["label"] for r in routing.route(df, "t").collect()] == [
        "ACCOUNT_LOOKUP", "TOP_PRIORITY_ACCOUNTS", "TOTAL_EXPECTED_RECOVERY", "COBAC_REGULATORY_REPORT", "CHANNEL_BREAKDOWN", "HELP", "ACCOUNT_LOOKUP", "DEFAULT"]


# ---- metrics and folds -------------------------------------------------------------------------

def test_ranking_metrics_with_ties(spark):
    r = random.Random(9)
    data = [(f, r.randrange(20) / 20, int(r.random() < 0.3)) for f in (0, 1) for _ in range(150)]
    out = {x["fold"]: x for x in ranking_metrics(spark.createDataFrame(data, "fold int, s double, y int"), "s", "y", ["fold"]).collect()}
    for f in (0, 1):
        pos, neg = [s for g, s, y in data if g == f and y], [s for g, s, y in data if g == f and not y]
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        ap, last = 0.0, 0.0
        for s in sorted({*pos, *neg}, reverse=True):
            tp, fp = sum(p >= s for p in pos), sum(q >= s for q in neg)
            ap += (tp / len(pos) - last) * tp / (tp + fp)
            last = tp / len(pos)
        assert out[f]["roc_auc"] == pytest.approx(auc) and out[f]["pr_auc"] == pytest.approx(ap)


def test_date_folds_cut_between_days(spark):
    df = spark.createDataFrame([(day(i),) for i in range(13) for _ in range(3)], "d date")
    got = dict(rows(date_folds(df, "d", 5).fillna(-1), "d", "val_fold"))
    assert [got[day(i)] for i in range(13)] == [-1, -1, -1, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_search_draws_repeat(spark):
    assert models.draw_parameters(3) == models.draw_parameters(3) != models.draw_parameters(4)


# ---- repaired cases ----------------------------------------------------------------------------

def test_missing_probability_has_no_value(spark):
    df = spark.createDataFrame([(None, 5000.0), (0.5, 5000.0)], "p double, a double")
    out = [r[0] for r in df.select(dec.channel_value(F.col("p"), F.col("a"), 50.0, 1.0).alias("v")).collect()]
    assert out == [None, 2450.0]


def test_payments_of_two_loans(spark):
    bal = spark.createDataFrame([(1, 1, 100.0), (1, 2, 80.0), (2, 1, 50.0)], "account_id int, loan int, b double").select("account_id", "loan", F.col("b").cast("decimal(18,2)").alias("balance_due"))
    pay = spark.createDataFrame([(1, 2, "60", "a", day(1)), (2, 1, "x", "b", day(1)), (2, 1, "-5", "c", day(1)), (9, 1, "5", "d", day(1))], "account_id int, loan int, amount string, payment_id string, paid_at date")
    out = dec.reconcile(bal, pay, ["account_id", "loan"]).collect()
    assert [(r["payment_id"], float(r["due_before"]), float(r["due_after"])) for r in out] == [("a", 80.0, 20.0)]
    assert rows(dec.reconcile_rejects(bal, pay, ["account_id", "loan"]), "payment_id", "reject_rule") == [("b", "unreadable_amount"), ("c", "amount_not_positive"), ("d", "unknown_account")]
    assert rows(dec.reconcile_rejects(bal, pay), "payment_id", "reject_rule")[0] == ("a", "ambiguous_account")
    assert dec.reconcile(bal, pay).count() == 0


def test_strict_settlement_of_a_hot_account(spark):
    prom = spark.createDataFrame([(f"p{i}", 1, "PENDING", day(i), 30.0, "") for i in range(6)] + [("q", 2, "PENDING", day(9), 1.0, "")], "promise_id string, account_id int, status string, promise_date date, amount_fcfa double, resolution_note string")
    pay = spark.createDataFrame([(1, str(10), f"{i}", day(i)) for i in range(1, 5)], "account_id int, amount string, payment_id string, paid_at date")
    assert rows(dec.settle_promises(prom, pay, require_full=True), "promise_id", "status") == [
        ("p0", "PENDING"), ("p1", "PENDING"), ("p2", "PENDING"), ("p3", "KEPT"), ("p4", "KEPT"), ("p5", "KEPT"), ("q", "PENDING")]


def test_short_history_is_an_error(spark):
    df = spark.createDataFrame([(day(i),) for i in range(5)], "d date")
    with pytest.raises(Exception, match="5 folds need at least 6 days"):
        date_folds(df, "d").collect()
    assert date_folds(df, "d", 4).count() == 5


def test_models_fit_on_a_small_frame(spark):
    r = random.Random(1)
    data = [(i, i // 4, r.gauss(i % 2, 0.6), float(i % 2), i % 2, float(5 + i % 7), 0.5 + (i % 5) / 10) for i in range(160)]
    df = spark.createDataFrame(data, "SK_ID_PREV int, SK_ID_CURR int, x double, y double, recovered int, days_to_cure double, paid_share double")
    fitted = models.fit_recovery_models(df, ["x"], ["days_to_cure"], (2, 2, 2))
    out = models.predict_recovery(df, fitted).collect()
    assert all(0 <= o["recovery_probability"] <= 1 and 1 <= o["estimated_days_to_cure"] <= 30 and 0.35 <= o["partial_recovery_ratio"] <= 1 for o in out)
    kept, broken = ([o["recovery_probability"] for o in out if o["recovered"] == k] for k in (1, 0))
    assert sum(kept) / len(kept) > sum(broken) / len(broken)
    with pytest.raises(ValueError):
        models.fit_recovery_models(df, ["x", "days_to_cure"], ["days_to_cure"], (1, 1, 1))


def test_recovery_models_are_fitted_two_at_a_time(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(models, "side_by_side", lambda session, tasks, at_once=4: calls.append((len(tasks), at_once)) or [t() for t in tasks])
    model = models.fit_recovery_models(spark.createDataFrame(_recovery_rows(), _RECOVERY), ["x", "y"], ["days_to_cure"], (1, 1, 1))
    assert calls == [(3, 2)]
    assert [type(s).__name__ for s in model.stages[-5:]] == ["CalibratedModel", "GBTRegressionModel", "BoundedScore", "GBTRegressionModel", "BoundedScore"]


@pytest.mark.parametrize("name", ["recovery_flow", "recovery_model_saved_and_loaded"])
def test_recovery_queries_fit_all_rounds(spark, monkeypatch, name):
    from ledgerloom.plans import modeling

    class Fitted(Exception):
        pass

    def make(max_iter, *rest):
        raise Fitted(max_iter)

    rows = spark.createDataFrame(_recovery_rows(), _RECOVERY).withColumn("is_test", F.col("SK_ID_CURR") % 4 == 0)
    monkeypatch.setattr(modeling, "recovery_frame", lambda spark, sf: rows)
    monkeypatch.setattr(modeling, "FEATURE_COLUMNS", ["x", "y"])
    monkeypatch.setattr(models, "gradient_boosting", make)
    monkeypatch.setattr(models, "GBTRegressor", lambda **settings: regressors.append(settings["maxIter"]))
    monkeypatch.setattr(models, "side_by_side", lambda session, tasks, at_once: tasks[0]())
    regressors = []
    with pytest.raises(Fitted, match="180"):
        modeling.R.queries[name](spark, "")
    assert regressors == [120, 100]
    assert spark.sparkContext.getCheckpointDir() is not None


def test_recovery_vectors_hold_what_trees_can_use(spark, monkeypatch):
    """Medians as they are, and a flag only for the column that lacks values; nothing is written on the way."""
    from ledgerloom.operators import encoding

    written = []
    monkeypatch.setattr(encoding, "materialize", lambda df, name="stage": written.append(name) or df)
    prep, vectors = models.recovery_preprocessor(["x", "y"]).fit(spark.createDataFrame(_recovery_rows(), _RECOVERY))
    got = {v["SK_ID_PREV"]: (v["x"], list(v["features"].toArray())) for v in vectors.select("SK_ID_PREV", "x", "features").collect()}
    assert got[10] == (got[10][0], [got[10][0], 0.0, 0.0]) and got[9][1][0] == got[9][0] and got[9][1][2] == 1.0
    assert prep.slots(vectors) == [("x", 0, 1), ("y", 1, 1), ("y", 2, 1)] and written == []


def test_sigmoids_take_given_folds_and_margins_written_once(spark, monkeypatch):
    from ledgerloom.operators import stages
    from ledgerloom.operators.encoding import inner_fold

    written = []
    monkeypatch.setattr(stages, "materialize", lambda df, name="stage": written.append((name, df.columns)) or df.localCheckpoint())
    _, vectors = models.recovery_preprocessor(["x", "y"]).fit(spark.createDataFrame(_recovery_rows(), _RECOVERY))
    vectors = vectors.withColumn("given", inner_fold(F.col("SK_ID_PREV"), 3)).localCheckpoint()
    written.clear()
    make = lambda: models.gradient_boosting(2, 0.1, 3, 5, "recovered")
    own, given = (stages.CalibratedClassifier(make, 3, "recovered", "SK_ID_PREV", "p", fold).fit(vectors) for fold in (None, "given"))
    assert rows(own.transform(vectors), "SK_ID_PREV", "p") == rows(given.transform(vectors), "SK_ID_PREV", "p")
    assert written == [("margins", ["_m", "recovered"])] * 6


def _recovery_rows(n=160):
    r = random.Random(1)
    return [(i, i // 4, r.gauss(i % 2, 0.6), None if i % 9 == 0 else float(i % 2), i % 2, float(5 + i % 7), 0.5 + (i % 5) / 10, 1000.0 * (1 + i % 60), -9000.0 - 97 * i, 100.0 if i % 11 == 0 else -500.0) for i in range(n)]


_RECOVERY = "SK_ID_PREV int, SK_ID_CURR int, x double, y double, recovered int, days_to_cure double, paid_share double, overdue_amount double, days_birth double, days_employed double"


def test_whole_model_saved_loaded_and_used_for_decisions(spark, tmp_path):
    import duckdb
    from pyspark.ml import PipelineModel

    from ledgerloom.operators import decisions as dec
    from ledgerloom.operators import scores as sc

    df = spark.createDataFrame(_recovery_rows(), _RECOVERY)
    model = models.fit_recovery_models(df, ["x", "y"], ["days_to_cure"], (3, 2, 2))
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    columns = ["SK_ID_PREV", *sc.SCORES]
    new = df.drop("recovered", "days_to_cure", "paid_share")
    assert rows(model.transform(new), *columns) == rows(again.transform(new), *columns)

    table = str(tmp_path / "scores")
    with pytest.raises(ValueError, match="no score version"):
        sc.current_scores(spark, table)
    sc.write_scores(again, new, table, 1, ["overdue_amount", "days_birth", "days_employed"])
    sc.write_scores(again, new.filter("SK_ID_PREV < 50"), table, 2, ["overdue_amount", "days_birth", "days_employed"])
    (tmp_path / "scores" / "version=3").mkdir()
    assert sc.versions(spark, table) == [1, 2]
    assert sc.current_scores(spark, table).count() == 50
    with pytest.raises(Exception, match="exists"):
        sc.write_scores(again, new, table, 2, [])
    book = sc.decided_book(sc.current_scores(spark, table, 1), 30)
    got = [tuple(r) for r in book.select("SK_ID_PREV", "is_vulnerable", "recommended_channel", F.round("expected_net_recovery_fcfa", 4), "rank", "assigned_officer").orderBy("rank").collect()]
    # every column after the score, by SQL over the score table
    sql = f"""
    WITH s AS (SELECT * FROM '{table}/version=1/*.parquet'),
    v AS (SELECT *, coalesce(abs(days_birth) / 365.25, 40) >= 60 OR days_employed >= 0 OR (recovery_probability < 0.05 AND overdue_amount > 200000) AS vul,
      recovery_probability * partial_recovery_ratio * overdue_amount AS gross, partial_recovery_ratio * overdue_amount AS debt FROM s),
    n AS (SELECT *, gross - 50 AS sms, least(0.99, recovery_probability * 1.25) * debt - 500 AS call, least(0.99, recovery_probability * 1.45) * debt - 5050 AS visit FROM v),
    c AS (SELECT *, CASE WHEN vul THEN CASE WHEN overdue_amount >= 25000 THEN 'CALL' ELSE 'SMS' END
      WHEN visit > greatest(sms, call) AND overdue_amount >= 40000 AND recovery_probability >= 0.10 THEN 'FIELD_VISIT' WHEN call > sms THEN 'CALL' ELSE 'SMS' END AS ch FROM n),
    r AS (SELECT *, row_number() OVER (ORDER BY gross DESC, SK_ID_CURR, SK_ID_PREV) AS rank FROM c)
    SELECT SK_ID_PREV, vul, ch, round(gross - CASE ch WHEN 'FIELD_VISIT' THEN 5050 WHEN 'CALL' THEN 500 ELSE 50 END, 4), rank,
      CASE WHEN rank <= 30 THEN {list(dec.OFFICERS)}[(rank - 1) % 3 + 1] END FROM r ORDER BY rank"""
    assert got == duckdb.sql(sql).fetchall()


def test_preparation_keeps_its_codes(spark, tmp_path):
    from ledgerloom.operators.stages import Preparation, PreparationModel

    r = random.Random(2)
    data = [(i, r.choice(["a", "b", "c", None]), None if i % 7 == 0 else float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(data, "id int, c string, x double, label int")
    model, trained = Preparation(["x"], targets=["c"], label="label", key="id", missing_flags=True).fit_transform(df)
    assert trained.filter("c_enc is null").count() == 0
    model.write().save(str(tmp_path / "p"))
    again = PreparationModel.load(str(tmp_path / "p"))
    new = spark.createDataFrame([(1, "a", None), (2, "unseen", 1.0), (3, None, 2.0)], "id int, c string, x double")
    assert rows(model.transform(new), "id", "c_enc", "x_missing") == rows(again.transform(new), "id", "c_enc", "x_missing")
    assert again.uid == model.uid
    share = sum(x[3] for x in data) / 60
    assert abs(dict((x[0], x[1]) for x in rows(again.transform(new), "id", "c_enc"))[2] - share) < 1e-12


def test_trial_ledger_goes_on_after_a_stop(spark, tmp_path):
    ledger = models.TrialLedger(spark, str(tmp_path / "ledger"))
    tried, stopping = [], [True]

    def trial(p):
        tried.append(p["max_iter"])
        if stopping[0] and len(tried) > 3:
            raise RuntimeError("stopped")
        return spark.range(1).select((F.lit(p["max_iter"]) / 1000).alias("value"))

    assert ledger.remaining(6) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(RuntimeError, match="stopped"):
        models.run_trials(ledger, 6, trial, at_once=1)
    assert ledger.numbers() == [0, 1, 2]
    first = rows(ledger.history(), "number", "value", "max_iter", "learning_rate")
    stopping[0] = False
    (tmp_path / "ledger" / "trial=4").mkdir(exist_ok=True)  # what an attempt left that was stopped while it wrote
    models.run_trials(ledger, 6, trial, at_once=2)
    assert ledger.remaining(6) == [] and ledger.remaining(7) == [6]
    assert rows(ledger.history().filter("number < 3"), "number", "value", "max_iter", "learning_rate") == first
    assert rows(ledger.history(), "number", "max_iter") == [(n, float(models.draw_parameters(n)["max_iter"])) for n in range(6)]
    assert dict(rows(ledger.attempts(), "number", "attempts"))[3] == 2 and ledger.attempts().count() == 6
    assert dict(rows(ledger.attempts(), "number", "attempts"))[0] == 1
    best = [r["best_so_far"] for r in models.trial_history(ledger.history()).orderBy("number").collect()]
    values = [r["value"] for r in ledger.history().orderBy("number").collect()]
    assert best == [max(values[: i + 1]) for i in range(6)]
    assert models.search_summary(ledger.history()).first()["n_trials"] == 6
    n = len(tried)
    models.run_trials(ledger, 6, trial)
    assert len(tried) == n


def test_search_then_comparisons_on_the_same_folds(spark, tmp_path):
    from ledgerloom.plans import modeling as pm

    df = pm.training_frame(spark, "/root/testdata/sf0.001", 2)
    small = lambda number: {"max_iter": 1 + number, "learning_rate": 0.1, "max_depth": 2, "min_leaf": 5}
    history = pm.run_search(spark, df, str(tmp_path / "search"), 2, 1, small)
    assert pm.run_search(spark, df, str(tmp_path / "search"), 2, 1, small).count() == history.count() == 2
    best = pm.best_parameters(history)
    assert best["max_iter"] in (1, 2) and best["max_depth"] == 2
    three = {r["metric"]: r for r in pm.three_way(df, history, 1, 2).collect()}
    assert set(three) == {"roc_auc", "pr_auc"} and all(0 <= three["roc_auc"][c] <= 1 for c in ("raw", "engineered", "tuned"))
    tuned = {r["number"]: r["value"] for r in history.collect()}
    assert abs(three["roc_auc"]["tuned"] - max(tuned.values())) < 1e-12
    compared = pm.compare_models(df, "onehot", 1, 2, 2)
    assert sorted((r["model"], r["metric"]) for r in compared.collect()) == [(m, k) for m in ("gradient_boosting", "logistic_regression", "random_forest") for k in ("pr_auc", "roc_auc")]


def test_clustered_layout_opens_only_the_files_of_a_key(spark, tmp_path):
    from ledgerloom.sources.layout import files_with, lookup, write_clustered

    data = [(i % 500, f"r{i}") for i in range(4000)] + [(77, f"hot{i:05d}") for i in range(3000)] + [(None, "none")]
    df = spark.createDataFrame(data, "k int, v string")
    path = str(tmp_path / "laid")
    write_clustered(df, path, "k", 16, ["v"])
    n_files = spark.read.parquet(f"{path}/manifest").count()
    assert n_files > 8 and len(files_with(spark, path, 300)) == 1 and 1 < len(files_with(spark, path, 77)) < n_files
    for value in (0, 77, 300, 499, 9999, -1):
        found = lookup(spark, path, "k", value)
        assert rows(found, "k", "v") == sorted(r for r in data if r[0] == value)
        assert len(found.inputFiles()) <= len(files_with(spark, path, value))
    assert lookup(spark, path, "k", None).count() == 1
    assert spark.read.parquet(f"{path}/manifest").agg(F.sum("n_rows")).first()[0] == len(data)
    write_clustered(df.limit(0), str(tmp_path / "empty"), "k", 4)
    assert lookup(spark, str(tmp_path / "empty"), "k", 1).count() == 0


def test_epochs_are_folded_and_count_once(spark, tmp_path):
    from ledgerloom.streaming.epochs import EpochTable

    table = EpochTable(spark, str(tmp_path / "t"), ["k"], lambda: [F.sum("n").alias("n"), F.max("last").alias("last")], fold_after=4)
    want, most = {}, 0
    for epoch in range(18):
        data = [(k, epoch + k, epoch) for k in range(epoch % 3 + 1)]
        part = spark.createDataFrame(data, "k int, n bigint, last int").coalesce(1)
        table.save(part, epoch)
        if epoch % 5 == 0:
            table.save(part, epoch)  # delivered again
        for k, n, last in data:
            want[k] = (want.get(k, (0, 0))[0] + n, last)
        most = max(most, len([f for f in (tmp_path / "t").iterdir() if f.is_dir()]))
        if epoch in (2, 7, 17):
            assert {r["k"]: (r["n"], r["last"]) for r in table.read().collect()} == want
    assert most <= 2 * 4 + 2
    table.save(part, 3)  # folded long ago
    assert {r["k"]: (r["n"], r["last"]) for r in table.read().collect()} == want


def test_agents_without_a_date_are_kept_and_unreadable_dates_rejected(spark):
    dates = {"A1": None, "A2": "  ", "A3": "not a date", "A4": "2020-01-02"}
    raw = spark.createDataFrame([(k, "n", "t", "d", v, "x", "XAF 1.00", "open", "f", 0, i) for i, (k, v) in enumerate(dates.items())],
                                "agent_id string, agent_name string, town string, division string, registered_on string, agent_type string, float_limit_xaf string, status string, _file string, _block bigint, _row bigint")
    cleaned = loading.clean_agents(raw)
    assert rows(cleaned.accepted, "agent_id", "registered_on") == [("A1", None), ("A2", None), ("A4", datetime.date(2020, 1, 2))]
    assert rows(cleaned.rejects(), "rule", "n_rows") == [("bad_date", 1), ("loaded", 3)]


def test_area_in_parts_is_the_area(spark):
    from ledgerloom.operators.metrics import roc_area, score_cuts

    r = random.Random(5)
    df = spark.createDataFrame([(g, r.choice([0.1, 0.2, 0.2, r.random()]), int(r.random() < 0.3)) for g in "abc" for _ in range(300)] + [("d", 0.5, 1)], "g string, s double, y int")
    for cuts in ([], [0.2], score_cuts(df, "s", 16)):
        for by in (["g"], []):
            want, got = ranking_metrics(df, "s", "y", by), roc_area(df, "s", "y", by, cuts)
            assert rows(got, *by, "n_pos", "n_neg", "roc_auc") == rows(want, *by, "n_pos", "n_neg", "roc_auc")


def test_a_bad_value_in_a_later_copy_only_does_not_fail_the_delivery(spark):
    def delivery(*weights):
        data = [("c", "v", "i", "b", "h", "g", "40FT", "p", w, "XAF 5", "yes", "2020-01-02", "5", "YES", "f", 0, i) for i, w in enumerate(weights)]
        names = "container_id vessel_id importer_id broker_id hs_chapter goods_description container_type origin_port gross_weight_kg declared_value_xaf inspection_selected arrived_on days_to_clear delayed _file".split()
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in names) + ", _block bigint, _row bigint")

    vessels = spark.createDataFrame([("v",)], "vessel_id string")
    assert rows(loading.clean_containers(delivery("7", "heavy"), vessels), "container_id", "vessel_missing") == [("c", False)]
    with pytest.raises(ValueError, match="gross_weight_kg"):
        loading.clean_containers(delivery("heavy", "7"), vessels)


def test_importance_by_parts_of_the_margin(spark):
    from ledgerloom.operators.encoding import Preprocessor

    r = random.Random(3)
    data = [(i, r.random(), r.choice("abc"), r.choice("pqrs"), r.random() < 0.5, int(r.random() < 0.4)) for i in range(120)]
    df = spark.createDataFrame(data, "id int, x double, w string, v string, b boolean, y int").coalesce(1)
    prep, vectors = Preprocessor(["x"], ["w"], ["b"], ["v"], "target", "y", "id").fit(df)
    fitted, features = models.logistic_regression(120, 50, "y").fit(vectors), ["x", "w", "v", "b"]
    got = models.linear_permutation_importance(df, prep, fitted, features, "y", "id", 2)
    want = models.permutation_importance(df, lambda d: models.positive_score(fitted.transform(prep.transform(d))), features, "y", "id", 2)
    a, b = (rows(f, "feature", "importance_mean", "importance_std") for f in (got, want))
    assert [p[0] for p in a] == sorted(features)
    assert all(abs(p - q) < 1e-9 for m, n in zip(a, b) for p, q in zip(m[1:], n[1:]))


def _folders(spark, *names):
    """Folders in the shared folder whose name starts with one of the names."""
    import pathlib

    root = pathlib.Path(new_path(spark, "x")).parent
    return {p.name for p in root.glob("*") if p.name.rsplit("-", 1)[0] in names}


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle"):
            found.add(name)
    return found


def test_written_rows_leave_no_shuffle_files_and_no_intermediates(spark):
    from ledgerloom.session import FREE_KEY, condensed, materialize

    before, folders = _shuffle_files(spark), _folders(spark, "step", "end")
    count = lambda df: df.groupBy((F.col("id") % 7).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    out = condensed(lambda: count(materialize(count(spark.range(1000).repartition(5)), "step")), "end")
    assert _shuffle_files(spark) - before == set()
    assert rows(out, "id", "n") == [(i, 1) for i in range(7)]
    new = _folders(spark, "step", "end") - folders
    assert len(new) == 1 and new.pop().startswith("end-")
    assert spark.conf.get(FREE_KEY, None) is None


def test_kept_containers_are_written_typed_before_they_meet_vessels(spark):
    names = "container_id vessel_id importer_id broker_id hs_chapter goods_description container_type origin_port gross_weight_kg declared_value_xaf inspection_selected arrived_on days_to_clear delayed _file".split()
    data = [("c", v, "i", "b", "h", "g", "40FT", "p", w, "XAF 5", "yes", "2020-01-02", "5", "YES", "f", 0, i) for i, (v, w) in enumerate([("v", "7"), ("x", "8")])]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in names) + ", _block bigint, _row bigint")
    before = _folders(spark, "containers-once")
    out = loading.clean_containers(raw, spark.createDataFrame([("v",)], "vessel_id string"))
    assert [(r["vessel_id"], float(r["gross_weight_kg"]), r["vessel_missing"]) for r in out.collect()] == [("v", 7.0, False)]
    assert len(_folders(spark, "containers-once") - before) == 1
    assert "_file" not in out.columns


def test_transactions_keep_one_copy_of_the_rows(spark):
    columns = "txn_id agent_id service_code txn_ts amount_xaf fee_xaf status customer_msisdn _file".split()
    data = [("t1", " a1", "S1", "2020-01-02", "XAF 5", "1", "ok", "612345678", "f", 0, 0), ("t1", " a2", "S1", "2020-01-02", "XAF 6", "1", "ok", "612345678", "f", 0, 1), ("t2", "a9", "S1", "2020-01-02", "XAF 5", "1", "ok", "612345678", "f", 0, 2)]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", _block bigint, _row bigint")
    names = ("transactions-once", "transactions-known")
    before = _folders(spark, *names)
    out = loading.clean_transactions(raw, spark.createDataFrame([("A1",)], "agent_id string"), spark.createDataFrame([("S1",)], "service_code string"))
    assert [f.rsplit("-", 1)[0] for f in _folders(spark, *names) - before] == ["transactions-known"]
    assert rows(out.rows, "txn_id", "agent_id", "reject_rule", "raw_copies") == [("t1", "A1", None, 2), ("t2", "A9", "unknown_agent", 1)]


def test_features_keep_one_copy_of_the_containers(spark):
    from ledgerloom.operators import clearance

    data = [(f"c{i}", "i%d" % (i % 2), "b", "h", day(i // 3), i % 2, float(i % 5), 1.0, 10, 1) for i in range(12)]
    df = spark.createDataFrame(data, "container_id string, importer_id string, broker_id string, hs_chapter string, arrived_on date, delayed int, declared_value_xaf double, gross_weight_kg double, teu_discharged int, container_teu int")
    names = ("containers", "percentiles", "ordered")
    before = _folders(spark, *names)
    out = clearance.build_features(df)
    assert sorted(f.rsplit("-", 1)[0] for f in _folders(spark, *names) - before) == ["containers", "percentiles"]
    got = {r["container_id"]: r for r in out.collect()}
    assert len(got) == 12 and not [c for c in out.columns if c.startswith("_")]
    last = got["c9"]  # day 3: nine earlier rows, four of importer 1
    assert (last["broker_prior_count"], last["importer_prior_count"], last["importer_delay_rate"], last["port_same_day_count"]) == (9, 4, 1.0, 3)
    assert last["value_per_kg_pct_in_chapter"] == sum(i % 5 < 4 for i in range(9)) / 9


def test_importance_has_one_repeat_under_way(spark, monkeypatch):
    """An area per feature is written for each repeat, and scores are dealt once for it."""
    seen, whole = [], models.roc_area
    monkeypatch.setattr(models, "roc_area", lambda df, score, label, by, cuts: seen.append(df) or whole(df, score, label, by, cuts))
    r = random.Random(4)
    data = [(int(r.random() < 0.4), [r.random(), r.random()], i + 1) for i in range(40)]
    parts = spark.createDataFrame(data, "label int, _own array<double>, _pos bigint").withColumn("score", F.col("_own")[0] + F.col("_own")[1])
    before = _folders(spark, "areas")
    assert models.importance_of_parts(parts, ["a", "b"], 3).count() == 2
    assert [[x[0] for x in df.select("_repeat").distinct().collect()] for df in seen if "_repeat" in df.columns] == [[0], [1], [2]]
    assert len(_folders(spark, "areas") - before) == 3


def test_areas_deal_the_rows_once(spark):
    from ledgerloom.operators.metrics import roc_area

    plan = roc_area(spark.range(9).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("s"), (F.col("id") % 2).alias("y")), "s", "y", ["g"], [3.0, 5.0])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_fold_isolation_leaves_no_training_rows_behind(spark, monkeypatch):
    from ledgerloom.plans import modeling

    data = [(f"k{i}", i % 2, 1.0, 2.0, f"b{i % 3}", f"h{i % 2}", f"i{i}", None if i < 20 else (i - 20) // 8) for i in range(60)]
    df = spark.createDataFrame(data, "container_id string, delayed int, gross_weight_kg double, declared_value_xaf double, broker_id string, hs_chapter string, importer_id string, val_fold int")
    monkeypatch.setattr(modeling, "raw_frame", lambda spark, sf, columns: df)
    names = ("prepared", "modes", "codes", "categories", "category-numbers", "ordered", "folded", "learned")
    before = _folders(spark, *names)
    out = modeling.R.queries["fold_isolation_of_categories"](spark, "")
    new = sorted(f.rsplit("-", 1)[0] for f in _folders(spark, *names) - before)
    assert new == ["folded"] + ["learned"] * 10
    got = {(r["fold"], r["encoder"], r["column"]): (r["labels_learned"], r["labels_not_in_train"]) for r in out.collect()}
    assert got[0, "onehot", "importer_id"] == (20, 0) and got[4, "target", "importer_id"] == (52, 0) and got[4, "mode", "hs_chapter"] == (1, 0)
