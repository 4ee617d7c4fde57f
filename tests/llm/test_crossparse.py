import random
import zlib
from collections import Counter

import numpy as np

from tests.llm.rows import documents, prose
from tidegauge.llm import crossparse as cp

LETTERS = {"aa": "abcdefghij", "bb": "ijklmnopqr", "cc": "éàçüñabcde"}


def slow_phrases(text, reference):
    """Greedy longest matches, found by searching the reference."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        n, at = n + 1, at + size
    return n


def test_automaton_parses_greedily():
    rng = random.Random(1)
    for _ in range(60):
        reference = [rng.randrange(1, 4) for _ in range(rng.randint(1, 80))]
        text = [rng.randrange(1, 5) for _ in range(rng.randint(1, 60))]
        table, state, n = cp.Automaton(reference).table(), 0, 1
        for k, c in enumerate(text):
            found = int(table[state, c])
            n += (found & 1) if k else 0
            state = found >> 1
        ref = "".join(map(str, reference))
        assert n == slow_phrases("".join(map(str, text)), ref)


def test_parse_counts_whole_texts():
    samples = {k: prose(3, 400, v) for k, v in LETTERS.items()}
    known = cp.build(samples)
    texts = ["", None, prose(8, 700, LETTERS["bb"]), "ABC  abc!! def", "123", prose(9, 2000, LETTERS["cc"])]
    cost, letters = known.parse(texts)
    assert letters.tolist() == [False, False, True, True, False, True]
    clean = lambda t: " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split())
    for row, t in zip(cost, texts):
        for k, name in enumerate(known.languages):
            if t and clean(t):
                wanted = slow_phrases(clean(t), clean(samples[name])) * known.bits[k]
                cuts = (len(t) // cp.STRETCH + 3) * known.bits[k]
                assert abs(row[k] - wanted) <= cuts
    many = texts * 3
    assert np.array_equal(known.parse(many)[0][6:12], cost)


def corpus(spark):
    rows = []
    for i in range(300):
        name = list(LETTERS)[i % 3]
        rows.append((i, prose(i, 10 + i % 60, LETTERS[name]), name, None, None))
    return rows


def test_held_out_documents(spark):
    rows = corpus(spark)
    got = {r.doc_id: r for r in cp.identify(documents(spark, rows)).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang, *_ in rows) >= 298
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
    # what held-out rows say about their language, or claims of a single document, changes nothing
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, *x) for i, t, lang, *x in rows]
    again = {r.doc_id: (r.lang_pred, r.score) for r in cp.identify(documents(spark, other)).collect()}
    assert again == {i: (r.lang_pred, r.score) for i, r in got.items()}


def test_edge_rows(spark, edge, none):
    got = cp.identify(edge).collect()
    assert len(got) == edge.count()
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    assert by[0].lang_pred == by[6].lang_pred == by[18].lang_pred == "und" and by[0].score == 0.0
    assert by[15].lang_pred == "en"
    assert {r.lang_pred for r in cp.identify(edge.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}
    assert cp.identify(none).count() == 0
    kept = cp.accepted(edge)
    assert kept.columns == edge.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids <= {r.doc_id for r in got if r.lang_pred != "und"} and not ids & {0, 3 * 6, 6}
    assert cp.accepted(none).count() == 0 and cp.accepted(edge.drop("lang").selectExpr("*", "cast(null as string) lang")).count() == 0


def test_only_text_of_learned_languages_stays(spark):
    """Gibberish and languages without labels go, text of the learned ones stays, at every length."""
    rng = random.Random(11)

    def language(seed, letters):
        own = random.Random(seed)
        syllables = ["".join(own.choice(letters) for _ in range(2 + k % 3)) for k in range(30)]
        return lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    aa, bb, unnamed = language("a", "aeioutnrsl"), language("b", "aeioudkmpv"), language("c", "aeioutnrsl")

    def gibberish(n):
        return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(n))

    rows = [(i, (aa, bb)[i % 2](rng.randint(20, 300)), ("aa", "bb")[i % 2], None, None) for i in range(300)]
    rows += [(1000 + i, (aa, bb)[i % 2](n), None, None, None) for i, n in enumerate([3, 8, 15, 40, 100, 400, 3000] * 6)]
    rows += [(2000 + i, gibberish(n), None, None, None) for i, n in enumerate([60, 150, 400, 3000] * 6)]
    rows += [(3000 + i, unnamed(n), None, None, None) for i, n in enumerate([150, 400, 3000] * 6)]
    rows += [(None, aa(50), None, None, None), (None, gibberish(90), None, None, None), (1, bb(50), "aa", None, None)]
    kept = [r.doc_id for r in cp.accepted(documents(spark, rows)).collect()]
    assert Counter(kept) == Counter([r[0] for r in rows if r[0] is not None and r[0] < 2000] + [None])


def test_bounds_grow_by_one_law():
    samples = {"aa": " ".join(prose(i, 80, LETTERS["aa"]) for i in range(60))}
    known, bounds = cp.build(samples), cp.bounds_of(samples)
    n = np.arange(1, 2000)
    most = bounds.phrases(n)[:, 0]
    assert (np.diff(most) > 0).all() and np.isclose(most[-1], cp.MARGIN * bounds.rate[0] * 1999 + cp.DEVIATIONS * bounds.spread[0] * 1999**0.5 + cp.DEVIATIONS)
    assert known.known([prose(i, 200, LETTERS["aa"]) for i in range(500, 520)] + [None, "", "12 !"], bounds) == [True] * 20 + [False] * 3
    assert cp.build({}).known(["a", None], cp.bounds_of({})) == [False, False]


def test_languages_with_long_texts_are_learned(spark):
    # one huge text among short ones, few long texts, one text, many empty ones
    rows = [(i, prose(i, 90, LETTERS["aa"]), "aa") for i in range(400)] + [(1000, prose(1, 400_000, "zyxwv"), "aa")]
    rows += [(2000 + i, prose(i, 60_000, LETTERS["bb"]), "bb") for i in range(9)] + [(3000, prose(5, 20_000, LETTERS["cc"]), "cc")]
    rows += [(4000 + i, "12 34", "cc") for i in range(300)]
    rows = [(i, t, lang, None, None) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1 or lang != "cc"]
    if not any(r[2] == "cc" and len(r[1]) > 9 for r in rows):
        rows.append((3001, prose(5, 20_000, LETTERS["cc"]), "cc", None, None))
    known = cp.learn(documents(spark, rows).repartition(8))
    assert known.languages == ["aa", "bb", "cc"]
    assert min(2 ** known.bits) >= 20_000
    texts = [prose(900 + k, 60, v) for k in range(20) for v in LETTERS.values()]
    assert [lang for lang, _ in known.predict(texts)] == list(LETTERS) * 20


def test_long_text_gives_no_more_than_a_slice_where_there_are_many(spark):
    rows = [(i, prose(i, 90, "abcdefghij"), "aa", None, None) for i in range(400)] + [(1000 + i, prose(i, 40_000, "z"), "aa", None, None) for i in range(3)]
    known = cp.learn(documents(spark, rows))
    # without the bound the three long texts hold 95 % of the letters
    cost, _ = known.parse([prose(77, 200, "abcdefghij"), prose(78, 200, "z")])
    assert 2 ** known.bits[0] >= 20_000 and cost[0][0] < 700 * known.bits[0]


def test_scripts_with_many_letters_are_told_apart(spark):
    # two scripts of 400 letters that share the first half, and one of Latin letters with accents
    han = [chr(0x4E00 + i) for i in range(600)]
    scripts = {"s1": "".join(han[:400]), "s2": "".join(han[:200] + han[400:]), "s3": "abcdefghijklmnopqrstuvwxyzàâäçéèêëîïôöùûüÿñ"}
    samples = {k: prose(3, 3000, v) for k, v in scripts.items()}
    known = cp.build(samples)
    texts = [prose(80 + k, 30, v) for k in range(10) for v in scripts.values()] + [han[500] * 9 + "q" + chr(0x3042) * 5 + " " + han[0]]
    cost, _ = known.parse(texts)
    clean = lambda t: " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split())
    for row, t in zip(cost, texts):
        for k, name in enumerate(known.languages):
            wanted = slow_phrases(clean(t), clean(samples[name])[: cp.REFERENCE_CHARS])
            assert abs(row[k] / known.bits[k] - wanted) <= 2
    assert [lang for lang, _ in known.predict(texts[:30])] == list(scripts) * 10
    rows = [(i, prose(i, 60, list(scripts.values())[i % 3]), list(scripts)[i % 3], None, None) for i in range(90)]
    got = {r.doc_id: r.lang_pred for r in cp.identify(documents(spark, rows)).collect()}
    assert all(got[i] == lang for i, _, lang, *_ in rows)
