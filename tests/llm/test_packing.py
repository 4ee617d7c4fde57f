import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.rows import documents, prose
from tidegauge.llm import packing, simhash
from tidegauge.llm.common import vocabulary

VOCABULARY = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)  # as it is by default


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_words_have_the_tokenizers_ids(tokenizer):
    texts = [
        "It's don't WE'LL I'd  x's 'S 'b", "q ét́ İI Σας ǅ ß SS ½ a½b 12ab_-x!!'re'll", "\x1cab\x1d \x00 \x7f a​b\xa0c",
        "<|endoftext|> a<|startoftext|>b", "<|endoftext|>", "<|startoftext|>", "x <|endoftext|> y", "x<|endoftext|>y<|startoftext|>",
        "<|ENDOFTEXT|> <|end oftext|> <||> |>", "<|startoftext|><|endoftext|> tail\n<|endoftext|>", "<<|endoftext|>>,<|endoftext|>'s",
        "日本語 ñÑ ÿŸ ×÷ µ ª º naïve—dash…", "a@b.com http://x.y/z?q=1&r=#2", "",
    ]
    words = packing.WordIds(VOCABULARY)
    for t in texts:
        assert b"".join(map(words.__getitem__, t.encode().split())) == ids_of(tokenizer, t)[:-1].tobytes(), t


def check(tokenizer, rows, got, window=2048):
    """Every id of every row lies in exactly one piece; sequences have no gaps and fit."""
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        for at in range(0, len(ids), window):
            part = ids[at : at + window]
            wanted[(doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == wanted
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for places in by.values():
        end = 0
        for offset, length, _ in sorted(places):
            assert offset == end
            end += length
        assert end <= window and {p[2] for p in places} == {end}
    return [sum(p[1] for p in places) for places in by.values()]


def test_other_tasks_do_not_carry_the_words_along():
    kept = packing.word_ids(VOCABULARY)
    assert kept[b"word"] and packing.word_ids(VOCABULARY) is kept
    assert not list(simhash._group_links(iter([])))  # a task of another stage in the same worker process
    fresh = packing.word_ids(VOCABULARY)
    assert fresh is not kept and not fresh and fresh[b"word"] == kept[b"word"]


def test_round_trip_with_little_padding(spark, tokenizer):
    rows = [(i, prose(i, 5 + (i * 37) % 700), None, None, None) for i in range(300)]
    special = ["<|endoftext|>", "one<|startoftext|>two", "a <|endoftext|> b", "<|startoftext|> c<|endoftext|>"]
    rows += [(300 + i, t, None, None, None) for i, t in enumerate(special)]
    full = check(tokenizer, rows, packing.pack(documents(spark, rows), VOCABULARY).collect())
    assert sum(2048 - n for n in full) < 0.02 * 2048 * len(full)


def test_one_length_holds_most_pieces(spark, tokenizer):
    rows = [(i, "a few words", None, None, None) for i in range(2500)]
    full = check(tokenizer, rows, packing.pack(documents(spark, rows), VOCABULARY).collect())
    assert len(full) == 5


def test_least_squares_use_what_is_there():
    histogram = np.zeros(65, np.int64)
    histogram[[10, 54, 20, 24, 40]] = [7, 5, 9, 3, 4]
    plan = packing.plan(histogram, 64)
    used = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 64
        for length in pattern:
            used[length] += n
    assert used == Counter({i: int(n) for i, n in enumerate(histogram) if n})
    combos = [(10, 54), (20, 20, 24), (24, 40)]
    counts = packing.repeat_counts(combos, histogram)
    dense = np.zeros((65, 3))
    for j, c in enumerate(combos):
        for length in c:
            dense[length, j] += 1
    # the optimum of non-negative least squares: no gain along any column
    gradient = dense.T @ (dense @ counts - histogram)
    assert (counts >= 0).all() and (gradient > -0.6).all() and abs(gradient @ counts) < 1.5
    assert packing.plan(np.zeros(65, np.int64), 64) == []


def test_edge_rows(edge, none, tokenizer):
    check(tokenizer, [(r.doc_id, r.text) for r in edge.collect()], packing.pack(edge, VOCABULARY).collect())
    assert packing.pack(none, VOCABULARY).count() == 0
