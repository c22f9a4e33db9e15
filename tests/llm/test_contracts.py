"""Every registered query over whole tables against the plain version of its contract, or its SQL."""

import public_tokenizers
import pytest
from compare import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm import plain

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def query(n):
    return next(q for name, q in QUERIES.items() if name.startswith(f"op{n}_"))


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def rows(spark, n, key="doc_id"):
    out = query(n)(spark, SF).collect()
    return {r[key]: r for r in out}, len(out)


def test_all_ten_and_the_pipeline_are_registered():
    for n in range(1, 11):
        assert query(n)
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("n", [3, 8, 10])
def test_sql(spark, n):
    name = next(x for x in QUERIES if x.startswith(f"op{n}_"))
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_repeats(spark, docs):
    got, n = rows(spark, 1)
    assert n == len(docs)
    assert [(i, got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) for i, _ in docs] == plain.repeats(docs)


def test_urls(spark):
    got, n = rows(spark, 2, "page_id")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert n == len(pages)
    for p, (verdict, score) in zip(pages, plain.url_verdicts([p.url for p in pages])):
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == plain.url(p.url)[:3]
        assert r.verdict == verdict
        assert r.score == pytest.approx(score, abs=1e-8)


def test_secrets(spark, docs):
    got, n = rows(spark, 4)
    assert n == len(docs)
    for i, t in docs:
        base = plain.secrets(t)
        assert got[i].base_sha256 == plain.sha(",".join(base))
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex")]
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("token")] == base


def test_quality(spark, docs):
    got, n = rows(spark, 5)
    assert n == len(docs)
    for i, t in docs:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality(t)
        assert not (r.base_failed and r.kept)


def test_tokens(spark, docs):
    got, n = rows(spark, 6)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert n == len(docs)
    for i, t in docs:
        want = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), want, want > 2048)


def test_simhash(spark, docs):
    got, n = rows(spark, 7)
    prints = [plain.fingerprint(t) for _, t in docs]
    assert n == len(docs)
    assert [got[i].fingerprint for i, _ in docs] == [f"{f:016x}" for f in prints]
    assert [got[i].component_id for i, _ in docs] == plain.components([i for i, _ in docs], prints)


def test_personal_data(spark, docs):
    got, n = rows(spark, 9)
    assert n == len(docs)
    for i, t in docs:
        base = plain.personal(t)
        assert got[i].base_sha256 == plain.sha(",".join(base))
        assert [s for s in got[i].spans.split(",") if s and "_like" not in s] == base
