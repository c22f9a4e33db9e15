"""Where a text is cut to a number of tokens, against the longest prefix that fits."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import token_prefix

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(3)
    of = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    return [
        None, "", "  \n ", "one two  three ", of("漢字日本語の文章", 300), of("abcdefghijklmnopqrstuvwxyz", 400), of("abcXYZ0189+/", 300),
        "function(){return a[0]&&b!=c;}" * 20, "plain words then " + of("aeiounrst", 200) + " end", "it's they're we'll don't " * 12,
        "éàx́" * 60, "İstanbulﬁ" * 30, " a　b" * 50, of("'srevd ", 300), of("👍🏽é!ß漢 a", 300)]


@pytest.mark.parametrize("limit", [0, 1, 17, 60])
def test_cut_is_the_longest_prefix(spark, limit):
    tokenizer = Tokenizer.from_file(PATH)
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id bigint, text string").repartition(3)
    for r in token_prefix.token_counts(df, PATH, limit, ["doc_id", "text"]).collect():
        t = r.text or ""
        counts = [len(e) for e in tokenizer.encode_batch([t[:i] for i in range(len(t) + 1)], add_special_tokens=False)]
        assert (r.n_tokens, r.cut_chars) == (counts[-1], max(i for i, n in enumerate(counts) if n <= limit)), t
