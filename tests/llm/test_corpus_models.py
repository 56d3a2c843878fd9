"""Prefix trie, backoff scores and ranked search against brute force, and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import katz, ranking, trie

TALK = "conv_id long, turn long, role string, text string, depth long, k1 long, length int, words string, n_convs string, tail int"
DOCS = "doc_id long, text string, t string, n long, lot long, train string, words int, m string, bag int, members int"


def talks(spark, rows):
    """Conversations with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, 9, 9, 9, "keep", "keep", 9) for r in rows], TALK)


def docs(spark, rows):
    return spark.createDataFrame([(*r, "keep", 9, 9, "keep", 9, "keep", 9, 9) for r in rows], DOCS)


# 11 prefix trie -------------------------------------------------------------------------------


def by_hand(rows):
    """The trie of rebuilt conversations by nested loops."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [r[3:] for r in sorted(v)] for c, v in own.items()}
    whole = {c: own.get(c - int(math.fmod(c, 20)), [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in own.items()}
    members, children = defaultdict(list), defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        m = members[node]
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(m) - 1) * words + sum(saved[x] for x in children[node])
        end = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(children[node]), leaves[node], saved[node], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_trie(spark):
    rng = random.Random(4)
    said = ["", "a", "a b", "yes  no ", "é\tx\n"]
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(said)) for c in [*range(-45, 90), 2**62] for t in range(rng.randrange(7))]
    assert rows_of(trie.rebuilt_trie(talks(spark, rows))) == by_hand(rows)


def test_trie_of_odd_turns(spark):
    """Nulls anywhere, repeated rows, ids without a base, conversations that lose all their turns, ties."""
    rows = [(None, 1, "user", "x"), (21, None, None, None), (21, None, "", ""), (22, 3, None, "a"), (22, 3, None, "a"), (22, None, "z", "first"), (41, 0, "user", None), (20, 5, "user", "b"), (20, 5, "bot", "a"), (63, 0, "u", "only"), (62, 0, "u", "only")]
    assert rows_of(trie.rebuilt_trie(talks(spark, rows))) == by_hand(rows)
    assert any(r[1] == 0 and r[7] != trie.NOTHING for r in by_hand(rows))  # some are rebuilt to nothing
    assert trie.rebuilt_trie(talks(spark, [])).count() == 0
    assert rows_of(trie.rebuilt_trie(talks(spark, rows[:1]))) == []


def test_trie_of_copies_and_long_conversations(spark):
    """Hundreds of equal conversations, one with hundreds of turns, one very long text; a sketch that is far too small."""
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)] + [(1000, t, "user", "again") for t in range(400)] + [(1001, 0, "user", "word " * 200_000)]
    want = by_hand(rows)
    assert rows_of(trie.rebuilt_trie(talks(spark, rows))) == want
    least, most = trie.LEAST_CELLS, trie.MOST_CELLS
    trie.LEAST_CELLS = trie.MOST_CELLS = trie.BLOCK
    try:
        many = [(c, t, "user", f"{c} {t}") for c in range(3000) for t in range(2)]
        assert rows_of(trie.rebuilt_trie(talks(spark, many + rows))) == by_hand(many + rows)
    finally:
        trie.LEAST_CELLS, trie.MOST_CELLS = least, most


def test_sketch_never_calls_a_shared_prefix_single(spark):
    rng = np.random.default_rng(1)
    k = rng.integers(-(2**62), 2**62, (2, 4000))
    k[:, 2000:2500] = k[:, :500]
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in k.T], "k1 long, k2 long").repartition(5)
    found = trie.may_be_shared(trie.sketch(rows, 1 << 15), *k)
    assert found[:500].all() and found[2000:2500].all() and (~found[500:2000]).mean() > 0.9


# 12 backoff -----------------------------------------------------------------------------------


def scored_by_hand(rows):
    """(n_tokens, n_known, train_tokens, base_score, score) of each (text, train), and P(word | context)."""
    said = [(katz.tokens(text), train) for text, train in rows]
    words, pairs = Counter(w for t, train in said if train for w in t), Counter()
    for t, train in said:
        pairs.update(zip([None, *t], t) if train else ())
    n, v = sum(words.values()), len(words)
    of_words, of_pairs = (katz.discounts([Counter(c.values())[r] for r in range(1, katz.KATZ + 2)]) for c in (words, pairs))

    def kept(count, share):
        return count * (share[count] if count <= katz.KATZ else 1)

    left, whole = n - sum(kept(c, of_words) for c in words.values()), n
    if left <= 0:
        left, whole = 1, n + 1
    follow = defaultdict(dict)
    for (a, b), c in pairs.items():
        follow[a][b] = c

    def alone(b):
        return (kept(words[b], of_words) if b in words else left) / whole

    def p(a, b):
        if a not in follow:
            return alone(b)
        held = sum(kept(c, of_pairs) for c in follow[a].values())
        gone = sum(follow[a].values()) - held
        gone = gone if gone > 1e-9 else 1
        if b in follow[a]:
            return kept(follow[a][b], of_pairs) / (held + gone)
        return gone / (held + gone) * alone(b) / (1 - sum(map(alone, follow[a])))

    out = [(len(t), sum(w in words for w in t), n, sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), sum(math.log10(p(a, b)) for a, b in zip([None, *t], t))) for t, _ in said]
    return out, p, words, follow


def some_texts(rng, n):
    words = ["the", "The", "a", "house", "tree", "é", "x y", *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choices(words, [60 / (i + 1) for i in range(len(words))], k=rng.randrange(25))) for _ in range(n)]
    return texts + [texts[0]] * 40 + ["", " \t ", None, None, "only once seen", "word " * 5000]


@pytest.mark.parametrize("split", [False, True])
def test_scores(spark, split):
    """Also with contexts dealt to several parts, and many small lots: the same scores."""
    rng = random.Random(2)
    rows = [(i if i % 50 else None, t, i % 5 != 1) for i, t in enumerate(some_texts(rng, 250))]
    want, p, words, follow = scored_by_hand([(t, train) for _, t, train in rows])
    for context in follow:
        assert abs(sum(p(context, w) for w in words) + p(context, b"never seen") - 1) < 1e-9
    table = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    sizes = katz.PART_TOKENS, katz.HOT, katz.LOT_CHARS
    if split:
        katz.PART_TOKENS, katz.HOT, katz.LOT_CHARS = 500, 50, 2000
    try:
        got = katz.score(table, F.col("learn")).collect()
    finally:
        katz.PART_TOKENS, katz.HOT, katz.LOT_CHARS = sizes
    key = lambda i, train, *x: (i is not None, i or 0, train, *(round(v, 6) for v in x))
    assert sorted(key(*r) for r in got) == sorted(key(i, train, *w) for (i, _, train), w in zip(rows, want, strict=True))


def test_grams_sum_to_one(spark):
    """The table's own probabilities and weights: what follows a context and what doesn't make 1 together."""
    rng = random.Random(3)
    table = docs(spark, list(enumerate(some_texts(rng, 120))))
    lots = katz.lots_of(table, F.lit(True))
    ids = katz.word_ids(lots)
    words = katz.learn_words(ids)
    rows = lots.select("lot", "doc_id", "train", "sizes", "tokens").join(ids.withColumnRenamed("n", "c"), "lot")
    model, share = katz.pair_model(katz.pair_table(rows, 3, 1), words)
    count = {}
    for r in ids.collect():
        count |= dict(zip(katz.unpack(r["id"]).tolist(), katz.unpack(r["n"]).tolist(), strict=True))
    alone = {w: float(words.p(np.array([c]))[0]) for w, c in count.items()}
    assert abs(sum(alone.values()) + float(words.p(np.zeros(1, np.int64))[0]) - 1) < 1e-9
    follow = defaultdict(list)
    for r in katz.grams(model, words, share).collect():
        follow[r["h"]].append(r)
    assert len(follow) > 50
    for seen in follow.values():
        assert abs(sum(r["p"] for r in seen) + seen[0]["weight"] * (1 - sum(alone[r["w"]] for r in seen)) - 1) < 1e-9


def test_scores_of_odd_tables(spark):
    assert katz.score(docs(spark, []), F.lit(True)).count() == 0
    got = katz.score(docs(spark, [(1, None), (None, "a b")]), F.lit(None).cast("boolean")).collect()  # nothing to learn from
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_discounts():
    assert katz.discounts([100, 40, 20, 12, 8, 5]).tolist() == pytest.approx([1, (0.8 - 0.3) / 0.7, (0.75 - 0.3) / 0.7, (0.8 - 0.3) / 0.7, (40 / 48 - 0.3) / 0.7, (30 / 40 - 0.3) / 0.7])
    for odd in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 1, 9, 1, 9], [9, 9, 9, 9, 9, 9]):
        share = katz.discounts(odd)
        assert share[0] == 1 and ((share[1:] > 0) & (share[1:] < 1)).all()


# 13 ranked search -----------------------------------------------------------------------------


def ranked_by_hand(documents, items, k=20):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    bags = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in documents)]
    n, total, df, out = sum(size > 0 for *_, size in bags), sum(size for *_, size in bags), Counter(t for _, b, _ in bags for t in b), []
    for item, text in items:
        found = []
        for i, bag, size in bags:
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * (75 + 25 * size * n // total))) for t in terms(text) if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "the house, THE tree"), (2, None), (3, ""), (4, "nothing here matches ?!"), (1, "é w1 w1 w2"), (None, "a"), (7, "w3 w4"), (7, "w3 w4")]


def test_ranked_search(spark):
    rng = random.Random(5)
    documents = [(i if i % 40 else None, t) for i, t in enumerate(some_texts(rng, 300))] + [(7, "the house")] * 60
    items = spark.createDataFrame([(i, t, "keep", 3) for i, t in ITEMS], "item_id long, text string, score string, copies int")
    want = ranked_by_hand(documents, ITEMS)
    assert len(want) > 80
    for block in (ranking.BLOCK_CHARS, 10):  # all items at once; a pass for few of them
        assert rows_of(ranking.search(docs(spark, documents), items, block_chars=block)) == want
    lot, products = ranking.LOT_CHARS, ranking.PRODUCTS
    ranking.LOT_CHARS, ranking.PRODUCTS = 100, 50
    try:
        assert rows_of(ranking.search(docs(spark, documents).repartition(3), items, k=3)) == ranked_by_hand(documents, ITEMS, 3)
    finally:
        ranking.LOT_CHARS, ranking.PRODUCTS = lot, products


def test_ranked_search_of_odd_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking.search(docs(spark, []), items).count() == 0
    assert ranking.search(docs(spark, [(1, None), (2, " ?")]), items).count() == 0
    assert ranking.search(docs(spark, [(1, "a")]), items.limit(0)).count() == 0
    assert ranking.search(docs(spark, [(1, "a")]), spark.createDataFrame([(2, None)], "item_id long, text string")).columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_bags_are_one_class(spark):
    """Copies by the hundred pass on no more than k members; different texts with the same item terms share a class."""
    items = ranking.Items(["x y"])
    held = ranking.bags(docs(spark, [(i, "x x other") for i in range(500)] + [(i, "X more x") for i in range(500, 900)] + [(1, "y")]), items)
    n, total, df = ranking.statistics(held, 2)
    assert (n, total, df.tolist()) == (901, 2701, [900, 1])
    found = {r["bag"]: [m["doc_id"] for m in r["members"]] for r in ranking.classes(held, n, total, 5).collect()}
    assert sorted(found.values()) == [[0, 1, 2, 3, 4], [1]]
