"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import chat_format, pii_votes, quality_forest, secret_scan, simhash_trie, source_mix, suffix_dedup, token_prefix, url_model, winnowing
from ledgerloom.llm.components import components
from tests.llm import plain

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row bigint, _id string, _h string, _txt string, fp string, spans string, size string, kept string, score string, stats string"
R = random.Random(4)
WORDS = [f"{a}{b}" for a in ("wo", "ra", "ti", "ne", "shé", "Ü") for b in ("lin", "dor", "mes", "tak", "𝒳y")]


def prose(n, r=R):
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(30_000)
SHARED = prose(120)
TEXTS = [
    None, "", " \t\n", "a", "one two three", LONG, LONG + " end", SHARED, SHARED, prose(9) + SHARED + prose(40), prose(60) + "\n" + SHARED, "x" * 5000, "1" * 3000, "+" * 3000, "a@" * 2000, "1.2.3.4." * 900,
    "mail a@b.cd_x@y.z, ip 1.2.3.4.5.6.7.8 999.1.1.1 007.1.2.3 +1 (555) 123-4567 4111 1111 1111 1111 41111111111111112", "PassWord: 'abc123' tokEn=\"zz\" AKIA" + "Q7" * 9 + " " + "deadbeef0" * 4,
    "line\nline\n\nline\n" + prose(40), "$$$ ### " * 30, "é" * 900 + prose(50), "\x00\x1f\x85\u00a0\u2028 odd\x0bspace " + prose(25), "<|endoftext|>a<|endoftext|> it's We'LL Ⅷ ½ \u0301x", "[INST] </s> \\ \\\\ <\\s>"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or ""), 9, *["9"] * 9) for i, t in enumerate(TEXTS)]
    rows += [(7, SHARED, "en", "s1", 1, 8, *["8"] * 9), (None, "no id " + prose(30), *[None] * 13), (None, None, *[None] * 13)]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def as_docs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("group_rows", [20_000, 2])
def test_repeats(spark, group_rows):
    r = random.Random(group_rows)
    parts = [bytes(r.choice(b"abc ") for _ in range(r.randrange(20, 90))).decode() for _ in range(5)]
    texts = [None, "", "a" * 300, "ab" * 150, "é" * 100]
    for i in range(60):
        texts.append("".join(r.choice(parts) if r.random() < 0.5 else prose(r.randrange(1, 6), r) for _ in range(r.randrange(0, 8))) if i % 9 else texts[-1])
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, parts[0] * 2)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(df, span=40, gram=8, group_rows=group_rows)
    assert sorted_rows(map(tuple, got.collect())) == sorted_rows(plain.repeats(docs, 40))


def test_repeats_of_edge_texts(table, nothing):
    docs = as_docs(table)
    got = suffix_dedup.remove_repeats(table, keep=["doc_id", "_row"], with_text=True).collect()
    assert sorted_rows(tuple(r)[:1] + tuple(r)[2:6] for r in got) == sorted_rows(plain.repeats(docs))
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=24), max_size=30), st.sampled_from([8, 16, 32]))
def test_deep_shallow_order(suffixes, shallow):
    order, prefix = suffix_dedup.deep_shallow_order(suffixes, 0, shallow)
    assert [suffixes[i] for i in order] == sorted(suffixes)
    assert all(prefix[k] == suffix_dedup.common_prefix(suffixes[order[k - 1]], suffixes[order[k]]) for k in range(1, len(order)))


URLS = [None, "", "nothing here", "HTTP://WWW.Example.NET/en/1?x", "http://net", "http://net/", "http://a.net?x/", "ftp://x.org/fr/é", "//example.com/de/", "a://b.example.com/de/://c", "http://example.com/deX", "http://EXAMPLE.com/de/x", "http://planet/", "http://İ.net/x"]


def test_urls(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3])], "page_id bigint, url string")
    got = url_model.filter_urls(df).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule, verdict = plain.url(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert url_model.filter_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in got if r.page_id in (0, 1)} == {"block"}


def test_url_models_tell_sites_apart(spark):
    r = random.Random(2)
    good = [f"https://{r.choice(['news', 'blog'])}{k}.example.net/en/story-{r.randrange(99)}" for k in range(150)]
    bad = [f"http://cheap-pills{k}.net/buy{r.randrange(999)}" for k in range(150)]
    free = ["https://news7.example.com/en/story-5", "http://cheap-pills77.example.com/buy12"]
    df = spark.createDataFrame(list(enumerate(good + bad + free)), "page_id bigint, url string")
    got = {x.page_id: x.verdict for x in url_model.filter_urls(df).collect()}
    assert (got[300], got[301]) == ("allow", "block")


EVENTS = [
    (1, 0, "message", 0, "user", "Hi"), (1, 1, "message", 1, "assistant", "He"), (1, 2, "delta", 1, None, "ll"), (1, 3, "delta", 1, None, "o"),
    (1, 4, "message", 2, "user", "again"), (1, 5, "regenerate", 1, "assistant", None), (1, 6, "delta", 1, None, "Bye"), (1, 7, "message", 2, "user", None), (1, 8, "edit", 0, "user", "Hey"),
    (2, 5, "delta", 0, "assistant", "b"), (2, 4, "delta", 0, "assistant", "a"), (2, 6, "edit", 1, "user", "late"), (3, 0, "message", 0, None, None)]


def test_events_fold(spark):
    df = spark.createDataFrame(EVENTS, chat_format.EVENTS)
    got = sorted(tuple(r) for r in chat_format.final_messages(df).select("conv_id", "message", "role", "text").collect())
    assert got == [(1, 0, "user", "Hey"), (1, 1, "assistant", "Bye"), (1, 2, "user", ""), (2, 0, "assistant", "ab"), (2, 1, "user", "late"), (3, 0, "", "")]


def test_chats_round_trip(spark):
    texts = [t for t in TEXTS if t != LONG] + list(chat_format.CONTROL) + ["<\\|turn|>", "<|te<|text|>xt|>", "\\<s>", "$1 \\$"]
    rows = [(i % 7, i, R.choice(["user", "assistant", "tool", "<|end|>", None]), t) for i, t in enumerate(texts)] + [(1, None, "user", "x"), (1, 1, "user", "x"), (1, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat_format.format_conversations(df)
    back = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for c in range(7):
        want = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for *_, r, x in want]
        assert back[c].loss_text == "".join(x for *_, r, x in want if r == "assistant")
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_secrets(spark, table, nothing):
    got = secret_scan.scan_secrets(table, keep=["doc_id", "text"]).collect()
    assert len(got) == table.count()
    assert all(r.base_sha256 == plain.sha(",".join(plain.secrets(r.text))) for r in got)
    assert secret_scan.scan_secrets(nothing).count() == 0


def test_owners_tell_examples_from_secrets(spark):
    example, live = "Zx81k2Mn40Pq9wRt77Yu", "q7Wn3eLm5Tz8Xc2Vb6Kj"
    docs = [(i, f"key {example} here", f"owner{i}") for i in range(6)] + [(9, f"see {live}.", "owner1"), (10, f"see {live}.", "owner1")]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()}
    assert got[9].spans == "token:4:24" and got[0].spans == "" and (got[0].n_example, got[9].n_live) == (1, 1)
    clean = secret_scan.redact(spark.createDataFrame([("a token=abcdef token=abcdef z", "assign:2:14,assign:15:27"), (None, "")], "text string, spans string"))
    assert sorted(x[0] or "" for x in clean.collect()) == ["", "a [SECRET] [SECRET] z"]


def test_quality(spark, table, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (9, 1, 0), (19, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_forest.judge_quality(table, labels, keep=["doc_id", "text", "kept"]).collect()
    assert len(got) == table.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality(r.text)
    for given_labels in (labels, labels.limit(0)):
        assert quality_forest.judge_quality(nothing, given_labels).count() == 0
    assert quality_forest.judge_quality(table, labels.limit(0)).filter("not base_failed and not kept").count() == 0


def test_forest_finds_held_out_junk(spark):
    r = random.Random(8)
    junk = lambda: " ".join(w + r.choice(["$$$", "###", "%%%"]) * (r.random() < 0.8) for w in prose(r.randrange(40, 200), r).split())
    docs = [(i, prose(r.randrange(40, 200), r), 1) for i in range(900)] + [(900 + i, junk(), 0) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, q int")
    got = {x.doc_id: x.kept for x in quality_forest.judge_quality(df, df.filter("doc_id % 2 = 0").select("doc_id", F.col("q").alias("quality"))).collect()}
    held = [(i, q) for i, _, q in docs if i % 2]
    assert sum(got[i] for i, q in held if q) >= 0.98 * sum(q for _, q in held)
    assert sum(not got[i] for i, q in held if not q) >= 0.9 * sum(not q for _, q in held)


def test_tokens(table, nothing):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for r in token_prefix.token_counts(table, TOKENIZER, 100, ["doc_id", "text"]).collect():
        t = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), count(t), count(t) > 100)
        assert count(t[: r.cut_chars]) <= 100
    short = table.filter(F.length("text") < 400)
    for r in token_prefix.all_prefix_counts(short, TOKENIZER, ["text"]).collect():
        assert r.prefix_tokens == [count(r.text[:i]) for i in range(len(r.text) + 1)]
    assert token_prefix.token_counts(nothing, TOKENIZER, 10, ["doc_id"]).count() == 0


@pytest.mark.parametrize("blocks,bucket_rows", [(None, 20_000), (6, 7), (8, 20_000)])
def test_simhash(spark, blocks, bucket_rows):
    r = random.Random(blocks)
    texts = [None, "", " ", "a", "a b", "A B"] + [prose(r.randrange(1, 60), r) for _ in range(60)]
    for _ in range(80):
        w = (r.choice(texts[6:]) or "x").split()
        w[r.randrange(len(w))] = r.choice(WORDS)
        texts.append(" ".join(w))
    docs = list(enumerate(texts)) + [(8, texts[8])]
    got = simhash_trie.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), blocks=blocks, bucket_rows=bucket_rows).collect()
    prints = [plain.fingerprint(t) for _, t in docs]
    want = zip((i for i, _ in docs), prints, plain.components([i for i, _ in docs], prints))
    assert sorted((x.doc_id, x.fingerprint, x.component_id) for x in got) == sorted((i, f"{f:016x}", c) for i, f, c in want)


def test_simhash_of_edge_texts(table, nothing):
    got = simhash_trie.near_duplicates(table, keep=["doc_id", "text", "fp"]).collect()
    assert len(got) == table.count()
    assert all(x.fingerprint == f"{plain.fingerprint(x.text):016x}" for x in got)
    assert simhash_trie.near_duplicates(nothing).count() == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    assert got == {n: find(n) for a, b in edges for n in (a, b) if a != b}


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, targets, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return targets | {s: level * weight[s] for s in free}
        targets |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return targets


@pytest.mark.parametrize("seed", range(4))
def test_mixing(spark, seed):
    r = random.Random(seed)
    docs = [(i, r.choice([None, "", prose(r.randrange(30), r)]), r.choice([None, "", "a", "B", "é", "𝒳", "z", *"hhhhhhhhh"])) for i in range(300)] + [(1, "x y", "a"), (None, "q", "only")]
    mixed = source_mix.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string"))
    got = mixed.collect()
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(plain.SPACE.findall(t or ""))
    targets = plain_targets(sizes)
    assert sorted_rows((x.doc_id, x.copies) for x in got) == sorted_rows((x.doc_id, x.copies) for x in mixed.collect())
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(targets[x.source]) and x.copies <= 2
    assert source_mix.emit(mixed).count() == sum(x.copies for x in got)


def test_mixing_of_edge_texts(table, nothing):
    assert source_mix.mix(table).count() == table.count()
    assert source_mix.mix(nothing).count() == 0


def test_personal_data(table, nothing):
    got = pii_votes.find_personal_data(table, keep=["doc_id", "text", "spans"]).toPandas()
    assert len(got) == table.count()
    for text, digest in zip(got["text"], got["base_sha256"]):
        assert digest == plain.sha(",".join(plain.personal(text)))
    assert pii_votes.find_personal_data(nothing).count() == 0


@settings(max_examples=1, deadline=None)
@given(st.just(0))
def test_em_finds_the_good_labeler(_):
    r = random.Random(0)
    rows = {}
    for _ in range(4000):
        truth = r.random() < 0.4
        votes = tuple(int(truth == (r.random() < p)) for p in (0.95, 0.8, 0.6))
        rows[votes] = rows.get(votes, 0) + 1
    _, rates, prior = pii_votes.expectation_maximisation(sorted(rows.items()))
    assert abs(prior - 0.4) < 0.06 and rates[0][0] - rates[0][1] > rates[1][0] - rates[1][1] > rates[2][0] - rates[2][1]


def test_written_out_addresses_are_added(spark):
    rows = [(i, f"please write to john.doe{i} (at) mail (dot) com today") for i in range(30)] + [(100 + i, f"mail jane{i}@mail.com or phone +1 (555) 123-45{i:02d}") for i in range(60)]
    got = {x.doc_id: x for x in pii_votes.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].spans == "mail_like:16:45" and got[0].n_added == 1
    assert got[100].n_email == 1 and got[100].n_phone == 1 and got[100].n_added == 0


def test_contamination(spark, table, nothing):
    items = [(1, prose(40)), (2, "Short, ITEM here"), (3, None), (4, ""), (5, "word"), (10, SHARED), (9, SHARED)]
    docs = [(100, items[0][1].upper()), (101, "x " + " ".join(items[0][1].split()[5:18]) + " y"), (102, " ".join(items[0][1].split()[5:17])), (103, "a short item here, word"), (104, prose(300) + " word"), (105, None), (105, None), (None, SHARED)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    both = table.select("doc_id", "text").union(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = winnowing.contamination(both, bench, keep=["doc_id", "text"]).collect()
    assert len(got) == both.count()
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == plain.contaminated(r.text, items)
    assert winnowing.contamination(nothing, bench).count() == 0
    assert winnowing.contamination(table, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0


def test_pipeline_on_edge_texts(spark, table, nothing, tmp_path):
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    for start in (table, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, str(tmp_path))
            assert after.columns[: len(docs.columns)] == docs.columns, name
            rows = [tuple(r) for r in after.collect()]
            docs = spark.createDataFrame(rows, after.schema)
    assert docs.count() == 0
