"""Files booked once and messages sent once, also when a run is repeated or was cut off."""

import pytest

from ledgerloom.operators.outbox import dispatch
from ledgerloom.streaming import intake


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


@pytest.fixture
def balances(spark):
    return spark.sql("SELECT * FROM VALUES (1L, 100BD), (2L, 50BD) AS t(account_id, balance_due)").selectExpr("account_id", "cast(balance_due as decimal(38,2)) balance_due")


def state(spark, out):
    booked = [(r.account_id, float(r.amount), float(r.due_before), float(r.due_after), r.outcome) for r in intake.read_result(spark, out, "booked").collect()]
    rejected = [(r.account, r.amount, r.reject_rule) for r in intake.read_result(spark, out, "rejected").collect()]
    audit = [(r.account_id, r.contact_outcome, r.notes) for r in intake.read_result(spark, out, "audit").collect()]
    return sorted(booked), sorted(rejected, key=str), sorted(audit)


def test_epochs_of_payment_files(spark, tmp_path, balances):
    out = str(tmp_path / "out")
    first = [lines(tmp_path / "a.csv", " SK_ID_CURR ,Paid", "1,60", "x,5", "2,oops", "3,7"), lines(tmp_path / "b.csv", "account_id,when", "1,2024-01-01"), lines(tmp_path / "empty.csv", "")]
    intake.book_epoch(spark, out, balances, first, 0)
    once = state(spark, out)
    assert once == (
        [(1, 60.0, 100.0, 40.0, "PARTIAL_PAYMENT")],
        sorted([("x", "5", "unreadable_account"), ("2", "oops", "unreadable_amount"), ("3", "7", "unknown_account")], key=str),
        [(1, "PARTIAL_PAYMENT", "Bulk payment settlement reconciled via CSV upload (60 FCFA).")])
    assert {r.path.rsplit("/", 1)[-1] for r in intake.read_result(spark, out, "files").collect()} == {"b.csv", "empty.csv"}
    intake.book_epoch(spark, out, balances, first, 0)  # tried again after it was finished
    assert state(spark, out) == once
    second = [lines(tmp_path / "c.csv", "client,CLIENT_ID,amount_fcfa,payment_id,paid_at", "z,1,50,p1,2024-01-02 00:00:00", "z,2,-1,p1,2024-01-02 00:00:00")]
    intake.book_epoch(spark, out, balances, second, 1)
    booked, rejected, _ = state(spark, out)
    assert booked == [(1, 50.0, 40.0, 0.0, "PAID_IN_FULL"), (1, 60.0, 100.0, 40.0, "PARTIAL_PAYMENT")]
    assert ("2", "-1", "amount_not_positive") in rejected and len(rejected) == 4


def test_unfinished_epoch_is_replaced(spark, tmp_path, balances, monkeypatch):
    out = str(tmp_path / "out")
    files = [lines(tmp_path / "a.csv", "account,amount", "1,60")]
    real = intake._write

    def cut_off(df, folder, kind, epoch):
        if kind == "audit":
            raise RuntimeError("lost")
        real(df, folder, kind, epoch)

    monkeypatch.setattr(intake, "_write", cut_off)
    with pytest.raises(RuntimeError):
        intake.book_epoch(spark, out, balances, files, 0)
    monkeypatch.setattr(intake, "_write", real)
    intake.book_epoch(spark, out, balances, files, 0)
    booked, _, audit = state(spark, out)
    assert booked == [(1, 60.0, 100.0, 40.0, "PARTIAL_PAYMENT")] and len(audit) == 1


def test_outbox_claims_once_and_repairs_the_log(spark, tmp_path, monkeypatch):
    from ledgerloom.operators import outbox

    messages = spark.sql("SELECT * FROM VALUES (1L, 1L, 'SMS', true, 5D, true), (1L, 1L, 'SMS', true, 5D, true), (2L, 1L, 'SMS', NULL, 5D, true), (3L, 1L, 'CALL', false, 5D, false) AS t(account_id, loan_id, channel, is_vulnerable, overdue, deliverable)")
    path = str(tmp_path / "campaign")
    real = outbox.audit_rows
    monkeypatch.setattr(outbox, "audit_rows", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dispatch(spark, path, messages, "C", "2024-01-01 09:00:00")
    monkeypatch.setattr(outbox, "audit_rows", real)
    assert dispatch(spark, path, messages, "C", "2024-01-01 09:00:00") == (0, 2)
    assert dispatch(spark, path, messages, "C", "2024-01-02 09:00:00") == (0, 0)
    assert dispatch(spark, path, messages.limit(0), "D", "2024-01-02 09:00:00") == (0, 0)
    assert sorted((r.account_id, r.is_vulnerable, r.notes) for r in spark.read.parquet(f"{path}/audit").collect()) == [(1, True, "Dispatched via bulk campaign: 'C'"), (2, False, "Dispatched via bulk campaign: 'C'")]
