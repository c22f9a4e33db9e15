"""Cross-tokenizer alignment against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import token_align as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "The cat sat.", "The cat sat.", "Élève où çà", "x▁y", "<s>a</s><|endoftext|><unk><0x41>", "漢字 mixed\ttabs\n\nlines  ", "\0nul", "tail spaces   ", "don't they'll 12345 !!!", "  wide ​spaces", "🙂🙂 ok", "word " * 700]


def plain(rows):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) by comparing every token of A with every token of B."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = ta.byte_letters()
    made = []
    for i, t in rows:
        groups, links = [], []
        if t:
            full = " " + t
            x = a.encode(full, add_special_tokens=False)
            ids_a, bytes_a = x.ids, [bytes(letters[c] for c in w) for w in x.tokens]
            ids_b = b.encode(t)
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(ids_b, b.encode(t, out_type=str))]
            if b"".join(bytes_a) == b"".join(bytes_b) == full.encode():
                start_a = start_b = 0
                done_a = 0
                for p in range(len(ids_a)):
                    done_a += len(bytes_a[p])
                    done_b = 0
                    for q in range(len(ids_b)):
                        done_b += len(bytes_b[q])
                        if done_a == done_b:
                            links.append((ids_a[p], ids_b[q]))
                            groups.append((ids_a[start_a : p + 1], ids_b[start_b : q + 1]))
                            start_a, start_b = p + 1, q + 1
        made.append((i, groups, links))
    n = Counter(p for _, _, links in made for p in links)
    most = {}
    for (_, y), k in n.items():
        most[y] = max(k, most.get(y, 0))
    out = []
    for i, groups, links in made:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links), sum(n[p] == most[p[1]] for p in links), sum(n[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return [tuple(r) for r in ta.token_alignment(df, A, B).collect()]


def test_whole_results_are_those_of_the_plain_version(spark):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "no id"), (7, "again")]
    assert sorted(run(spark, rows), key=key) == sorted(plain(rows), key=key)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:40]
    assert sorted(run(spark, rows), key=key) == sorted(plain(rows), key=key)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_columns_with_clashing_names_are_left_alone(spark):
    df = spark.createDataFrame([(1, "some text", 5, "x")], "doc_id bigint, text string, n_a int, _text string")
    found = ta.align_tokens(df, A, B, ["doc_id", "_text", "text"], give=["a_ids", "a_cuts", "b_cuts"])
    assert found.columns == ["doc_id", "_text", "text", "a_ids", "a_cuts", "b_cuts"]
    assert found.first()[:3] == (1, "x", "some text")


def test_both_libraries_give_the_same_ids():
    fast = ta.ByteLevel(A)
    assert fast._fast is not None
    for t in [t for t in TEXTS if t] + ["".join(chr(c) for c in range(k, k + 97)) for k in range(0, 0xD000, 997)]:
        assert fast.encode(t) == fast.slow().encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 300_000, "\n" * 100_000 + "x", "a" * 300_000, "ab " * 100_000])
def test_very_long_runs(text):
    a_ids, b_ids, a_cuts, b_cuts, x, y = ta.Aligner(A, B)(text)
    assert a_cuts[-1] == len(a_ids) and b_cuts[-1] == len(b_ids) and len(x) == len(y) == len(a_cuts)


def test_tokens_without_bytes_end_with_the_one_before():
    ids = np.array([7, 8, 9]), np.array([4, 5])
    ends = np.array([2, 2, 5]), np.array([2, 5])
    cuts = ta.common_cuts(*(e.tolist() for e in ends))
    assert cuts == ([2, 3], [1, 2])
    x, y = ta.links_of(*ids, *ends, *map(np.array, cuts))
    assert list(zip(x.tolist(), y.tolist())) == [(7, 4), (8, 4), (9, 5)]


def test_pairs_are_bounded_by_the_vocabularies(spark):
    aligner = ta.Aligner(A, B)
    by_bytes = {}
    for i, p in enumerate(aligner.b.pieces):
        by_bytes.setdefault(p, []).append(i)
    bound = ta.pair_bound(aligner.a.pieces, aligner.b.pieces)
    assert bound < 1_000_000
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert ta.link_counts(ta.align_tokens(df, A, B, ["doc_id"], give=["linked_a", "linked_b", "linked_n"])).count() < bound
