"""The operators against brute force, exact round trips and held-out rows, and on odd input."""

import hashlib
import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wattlake.llm import embeddings, langid, licences, mixing, parsing, pieces, quality, queries, simhash, toxicity, urls
from wattlake.llm.common import class_sample, labelled_sample, thinned
from wattlake.llm.graph import MinForest, components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _score double, _lang string, ids string, component_id long, rep string, _copies int, t string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 1.0, 2.0, "keep", "keep", 7, "keep", 9, "keep") for i, t, lang, s in rows], DOCS)


ODD = [(1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "12 34 !!", "en", "b"), (5, "word " * 40_000, "en", "a"), (6, "the same text again and again", "en", "a"), (6, "the same text again and again", "en", "a"), (None, "a text without an id", "en", "b"), (8, "\U0001d11e日本 é\x00", "de", "c")]


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet").cache()


def smallest_reachable(ids, linked):
    """Brute force: the smallest id of each one's component; *linked* is a boolean matrix."""
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[linked[i]].min(initial=label[i])) for i in range(len(ids))])
        if (new == label).all():
            return label
        label = new


# shared ---------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200), (None, 3)]
    got = {r["node"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    linked = np.zeros((len(nodes),) * 2, bool)
    for a, b in edges:
        if a in nodes and b in nodes and a != b:
            linked[nodes.index(a), nodes.index(b)] = linked[nodes.index(b), nodes.index(a)] = True
    assert got == dict(zip(nodes, smallest_reachable(nodes, linked).tolist(), strict=True))


def test_class_samples_are_bounded(spark):
    """One id with very many rows, or very long texts, bring no more rows or characters than the parameters say."""
    rows = spark.createDataFrame([(7, f"text {i}", "a") for i in range(3000)] + [(i, "x" * 50, "b") for i in range(2000)] + [(9, "z" * 5000, "c")], "id long, text string, class string")
    few = thinned(rows, rows.groupBy("class").agg(F.count("*").alias("n")), 40)
    got = Counter(c for _, c in class_sample(few, 40, 1000))
    assert got["b"] == 20 and got["c"] == 1 and got.get("a", 0) <= 40
    assert class_sample(few.repartition(7), 40, 1000) == class_sample(few, 40, 1000)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(5, 1 - 5 % 2)], "doc_id long, toxic int")
    texts = spark.createDataFrame([(i % 3000, f"t{i}") for i in range(9000)] + [(8, f"again {i}") for i in range(500)], "doc_id long, text string")
    assert all(n <= 30 for n in Counter(y for _, y in labelled_sample(texts, labels, "toxic", 30, 10_000)).values())
    with pytest.raises(ValueError):
        thinned(rows, spark.range(300).select(F.col("id").cast("string").alias("class"), F.lit(1).alias("n")), 5)


def test_forest():
    f = MinForest(6)
    f.link(np.array([5, 4, 1]), np.array([4, 3, 2]))
    assert f.find(np.arange(6)).tolist() == [0, 1, 1, 3, 3, 3]


# 1 fingerprints -------------------------------------------------------------------------------


def test_fingerprints_of_next(spark):
    got = sorted(parsing.against_next(docs(spark, ODD)).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    texts = [t or "" for _, t, _, _ in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    assert len(got) == len(ODD)
    for i, r in enumerate(got):
        following = texts[(i + 1) % len(texts)]
        changed = texts[i][: len(texts[i]) - len(texts[i]) // 2] + following[: len(texts[i]) // 2]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert [r["fingerprint"], r["edited_fingerprint"]] == parsing.fingerprints([texts[i], changed])
        assert r["near_next"] == parsing.likeness(*parsing.fingerprints([texts[i], following])) and 0 <= r["near_edited"] <= 1
    assert parsing.against_next(docs(spark, [])).count() == 0
    assert parsing.against_next(docs(spark, [(9, "alone here", "en", "a")])).first()["near_next"] == 1.0


def test_fingerprints_where_one_id_has_most_rows(spark):
    """Rows of one id are dealt to several tasks; every row has the next one of its order all the same."""
    rng = random.Random(6)
    text = lambda: "".join(rng.choice("abc def") for _ in range(rng.randint(0, 60)))
    rows = [(7, text(), "en", "a") for _ in range(400)] + [(None, text(), "en", "a") for _ in range(300)] + [(i, text(), "en", "a") for i in range(100)] + [(-(1 << 63), "least", "en", "a"), ((1 << 63) - 1, "most", "en", "a")]
    key = lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest(r[1].encode(), 42) & 0xFFFFFFFF, r[1])
    ordered = sorted(rows, key=key)
    pairs = list(zip(ordered, [*ordered[1:], ordered[0]], strict=True))
    want = sorted((repr(a[0]), len(a[1]), hashlib.sha256(parsing.edited(a[1], b[1]).encode()).hexdigest()) for a, b in pairs)
    got = parsing.against_next(docs(spark, rows).repartition(3)).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == want


def test_fingerprints_of_thousands_of_equal_rows(spark):
    """Rows alike in id and text come out of many tasks, each followed by its like and the last by the next text."""
    rows = [(None, "", "en", "a")] * 2500 + [(None, "no id either", "en", "a")] * 3 + [(7, "a copy of a copy", "en", "a")] * 1500 + [(i, f"text number {i}", "en", "a") for i in range(200)]
    key = lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest(r[1].encode(), 42) & 0xFFFFFFFF, r[1])
    ordered = sorted(rows, key=key)
    pairs = list(zip(ordered, [*ordered[1:], ordered[0]], strict=True))
    want = sorted((repr(a[0]), len(a[1]), hashlib.sha256(parsing.edited(a[1], b[1]).encode()).hexdigest(), parsing.likeness(*parsing.fingerprints([a[1], b[1]]))) for a, b in {(a, b): 0 for a, b in pairs})
    found = parsing.against_next(docs(spark, rows).repartition(5))
    got = found.withColumn("_part", F.spark_partition_id()).collect()
    assert sorted({(repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_next"]) for r in got}) == want
    assert Counter(repr(r["doc_id"]) for r in got) == Counter(repr(r[0]) for r in rows)
    assert max(Counter(r["_part"] for r in got if r["doc_id"] is None).values()) < 1700


def slow_phrases(names: list[int]) -> list[int]:
    """One level of phrases of one text by plain integers: runs, three further rounds of coin tossing, local maxima."""
    full = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        return x ^ (x >> 31)

    runs = []
    for n in names:
        if runs and runs[-1][0] == n:
            runs[-1][1] += 1
        else:
            runs.append([n, 1])
    names = [n if k == 1 else mix((n + k * 0x9E3779B97F4A7C15) & full) for n, k in runs]
    label = names
    for _ in range(4):
        left = [label[0] ^ 1, *label[:-1]]
        bits = [((a ^ b) & -(a ^ b)).bit_length() - 1 for a, b in zip(label, left)]
        label = [2 * i + (a >> i & 1) for a, i in zip(label, bits)]
    last = len(names) - 1
    begins = [i == 0 or (1 < i < last and label[i] > label[i - 1] and label[i] > label[i + 1]) for i in range(len(names))]
    out = []
    for i, n in enumerate(names):
        if begins[i]:
            out.append(0)
            start = i
        out[-1] = (out[-1] + mix(n ^ ((i - start + 1) * 0x9E3779B97F4A7C15 & full))) & full
    return [mix(x) for x in out]


def test_phrases_are_those_of_plain_integers():
    rng = random.Random(12)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for letters in ("ab", "abcdefgh ", "aaab", "日本é x") for _ in range(15)]
    levels = parsing.signatures(texts)
    for i, t in enumerate(texts):
        names = [x.tolist() for x, owner in [(n[o == i], o) for n, o in levels] if len(x)]
        now = parsing._mix(np.array([ord(c) + 1 for c in t], np.uint64)).tolist()
        for level in names:
            now = slow_phrases(now)
            assert now == level
        assert len(now) == 1
        # of each slot the least name of the levels that count, in 16 bits, 1 at least
        counted = [x for level in names[min(parsing.LEVEL, len(names)) - 1 :] for x in level]
        slots = [0] * parsing.SLOTS
        for slot in {x >> 57 for x in counted}:
            slots[slot] = max(1, min(x & ((1 << 57) - 1) for x in counted if x >> 57 == slot) & 0xFFFF)
        assert parsing.fingerprints([t])[0] == "".join(f"{x:04x}" for x in slots)


def test_fingerprint_partitions_agree(spark, documents):
    few = {r["doc_id"]: tuple(r) for r in parsing.against_next(documents).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert {r["doc_id"]: tuple(r) for r in parsing.against_next(documents.repartition(5)).collect()} == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_parsing_is_local():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage, other = " ".join(word() for _ in range(600)), " ".join(word() for _ in range(600))
    shifted, unlike = "some words before " + passage, other
    a, b, c = parsing.fingerprints([passage, shifted, unlike])
    assert parsing.likeness(a, b) > 0.8 and parsing.likeness(a, c) < 0.05
    assert parsing.fingerprints([passage])[0] == a and parsing.fingerprints([unlike, passage])[1] == a
    for names, owner in parsing.signatures(["aaaa" * 100, "", "x", passage]):
        assert len(names) == len(owner)


def test_length_does_not_change_the_phrases():
    """Near copies on either side of 40 and of 240 characters are as alike as any."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(100)]
    alike = lambda a, b: np.mean([parsing.likeness(*parsing.fingerprints([t[:a], t[:b]])) for t in texts])
    assert alike(238, 242) > 0.75 and alike(238, 242) > alike(228, 232) - 0.05
    assert alike(38, 42) > 0.35 and alike(38, 42) > alike(43, 47) - 0.1


# 2 toxicity -----------------------------------------------------------------------------------


def test_toxicity_grammar():
    rng = random.Random(0)
    clean = [" ".join("".join(rng.choice("abdegiklmnoprstu") for _ in range(5)) for _ in range(20)) + ". what a day, you" for _ in range(200)]
    toxic = [c + " zorgle! what a zorgling flibber." for c in clean[:80]]
    g = toxicity.fit([(t, 1) for t in toxic] + [(t, 0) for t in clean])
    assert g.insult("zorgle") > 1 and g.insult("zorgling") > 1 and g.insult("flibber") > 1 and not g.insult("zork")
    aimed, plain, denied, reported = (g.score(t) for t in ("you are a flibber", "a flibber", "she is not a flibber", "he said it was a flibber"))
    assert aimed >= plain > 0.5 > max(denied, reported) and g.score("sun and moon") < 0.2
    assert [k for k, _ in g.clauses("you flibber. not a flibber! i will kill you; kill the process")] == ["aimed", "denied", "threat"]
    assert g.score(None) == g.score("") == g.score("\n")


def test_threats_in_four_languages():
    rng = random.Random(4)
    clean = [" ".join("".join(rng.choice("abdegiklmnoprstu") for _ in range(5)) for _ in range(20)) for _ in range(200)]
    g = toxicity.fit([(t + " zorgle!", 1) for t in clean[:60]] + [(t, 0) for t in clean])
    kinds = lambda t: [k for k, _ in g.clauses(t.lower())]
    threats = ["I will be killing you", "te mataré", "je te tuerai", "Ich bringe dich um", "we'll beat him", "ich werde ihn umbringen", "on va vous détruire", "they should burn her"]
    for t in threats:
        assert kinds(t) == ["threat"] and g.score(t) >= toxicity.LIMIT, t
    for t in ("they hurt her feelings", "she destroyed them", "ils ont tué"):
        assert kinds(t) in (["harm"], []) and g.score(t) < 0.5, t
    for t in ("I will not kill you", "he said he will kill you", "kill the process", "ich bringe dir Tee", "wir gehen um das Haus", "matador, beautiful, stable"):
        assert not kinds(t) and g.score(t) < 0.5, t


def slow_clauses(text, grammar):
    """The matches of each clause by plain rules instead of transducers."""
    out = []
    for clause in re.split(r"[.!?;:\n]", text):
        kinds = [grammar.closed.get(w) or (toxicity.INSULT if grammar.insult(w) else toxicity.OTHER) for w in re.findall(r"\w+(?:'\w+)?", clause)]
        for i, k in enumerate(kinds):
            split = k == toxicity.BRING and toxicity.UM in kinds[i + 1 :] and toxicity.BRING not in kinds[i + 1 : i + 1 + kinds[i + 1 :].index(toxicity.UM)]
            k = toxicity.THREAT if split else k
            if k not in (toxicity.INSULT, toxicity.THREAT):
                continue
            second = toxicity.SECOND in kinds
            aimed = second or toxicity.TARGET in kinds
            denied, reported = toxicity.NEGATION in kinds[max(0, i - 3) : i], toxicity.REPORT in kinds[:i]
            if k == toxicity.THREAT:
                out += ["threat" if second or toxicity.INTENT in kinds[:i] else "harm"] if aimed and not denied and not reported else []
            else:
                out.append("denied" if denied else "reported" if reported else "aimed" if aimed else "plain")
    return out


def test_transducers_match_plain_rules():
    grammar = toxicity.Grammar({"flib": 3.0, "zorg": 2.0})
    rng = random.Random(14)
    words = ["flibber", "zorgling", "kill", "you", "not", "never", "said", "sun", "moon", "tree", "they", "burn", "will", "him", "bringe", "um", ".", ";", "\n"]
    for _ in range(600):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        assert [k for k, _ in grammar.clauses(text)] == slow_clauses(text, grammar), text
        want = [min(toxicity.MOST, sum(w * w for k, w in grammar.clauses(text) if k == kind) / toxicity.UNIT) for kind in toxicity.KINDS]
        assert np.allclose(grammar.features(text), want)


def test_toxicity_held_out(spark):
    lake = "/root/testdata/sf0.1"
    d, lab = spark.read.parquet(f"{lake}/documents.parquet"), spark.read.parquet(f"{lake}/labels.parquet")
    scored = queries.op2_toxicity(spark, lake).cache()
    rows = scored.join(lab, "doc_id").filter("held_out").collect()
    assert d.count() == scored.count()
    caught = sum(r["predicted"] and r["toxic"] for r in rows)
    assert caught >= 0.88 * sum(r["toxic"] for r in rows) and caught >= 0.86 * sum(r["predicted"] for r in rows)  # recall, precision
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)


def test_toxicity_odd(spark, labels):
    d = docs(spark, ODD)
    grammar = toxicity.learn(d, labels)
    scored = toxicity.score(d, grammar).select("doc_id", "text", "_tox.score").collect()
    assert len(scored) == len(ODD) and all(r["score"] == pytest.approx(grammar.score("")) for r in scored if not (r["text"] or "").strip())
    assert toxicity.score(docs(spark, []), toxicity.learn(docs(spark, []), labels.limit(0))).count() == 0


# 3 pieces -------------------------------------------------------------------------------------


def test_pieces_are_those_of_the_library(spark, documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    v = pieces.read_model(queries.PIECES)
    rng = random.Random(5)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 50))) for a in ("aab ", "  x", "thein gs", "日本のひ a", "éèñü aeiou", "<>0x41 \n\t", "▁ a", "0123456789 ,") for _ in range(60)]
    texts += ["a" * 300, " " * 50, "\U0001d11e 日本\x00", "", *[r["text"] for r in documents.limit(60).collect() if r["text"]]]
    mine = pieces.Encoder(v).encode(texts)
    assert [ids.tolist() for ids in mine] == library.encode(texts)
    assert [pieces.decode(ids, v) for ids in mine] == [t.replace("▁", " ") for t in texts]
    assert all(r["round_trip"] for r in pieces.round_trips(docs(spark, ODD), v).collect()) and pieces.round_trips(docs(spark, []), v).count() == 0
    encoded = pieces.with_text(pieces.with_ids(docs(spark, ODD), v), v)
    for r in encoded.select("text", "ids", "decoded").collect():
        assert r["decoded"] == r["text"] and (r["ids"] == library.encode(r["text"]) if r["text"] is not None else r["ids"] is None)
    assert pieces.with_ids(docs(spark, []), v).count() == 0


def test_models_that_normalise_are_refused(monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")

    class Folding(sentencepiece.SentencePieceProcessor):
        def encode(self, text, **kwargs):
            return super().encode(unicodedata.normalize("NFKC", text), **kwargs)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Folding)
    with pytest.raises(ValueError):
        pieces.read_model(queries.PIECES)


def test_adjacent_pieces_are_those_of_merging():
    v = pieces.read_model(queries.PIECES)
    rng, normal = random.Random(8), sorted(v.ids.values())
    short = [i for i in normal if len(v.pieces[i]) < 4]
    for _ in range(3000):
        a, b = rng.choice(short if rng.random() < 0.7 else normal), rng.choice(short if rng.random() < 0.7 else normal)
        assert v.adjacent(a, b) == (v.merge(v.pieces[a] + v.pieces[b]) == [v.pieces[a], v.pieces[b]])
        assert v.adjacent(-1, a) == (v.merge(v.pieces[a]) == [v.pieces[a]])


def test_small_tables_and_shared_classes_change_no_ids(monkeypatch):
    v = pieces.read_model(queries.PIECES)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aeiounst .,\n日本é") for _ in range(rng.randint(0, 200))) for _ in range(60)] + [None, ""]
    want = [None if x is None else x.tolist() for x in pieces.Encoder(v).encode(texts)]
    monkeypatch.setattr(pieces, "CLASSES", 40)
    small = pieces.Encoder(v, indexed=50, kept=10)
    for _ in range(2):
        assert [None if x is None else x.tolist() for t in texts for x in small.encode([t])] == want
    ids, ends = small.encode_lot(texts)
    assert small.digests(ids, ends)[0] == hashlib.sha256(" ".join(map(str, want[0])).encode()).hexdigest() and small.digests(ids, ends)[-1] == hashlib.sha256(b"").hexdigest()
    assert small.decode_lot(ids, ends)[:-2] == texts[:-2]


# 4 urls ---------------------------------------------------------------------------------------


def test_urls(spark):
    cases = {
        "http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"), "https://x.net/fr/2": ("x.net", "/fr/2", "net/", "block"), "https://x.net": ("x.net", "", None, None),
        "https://b.example.com/de/9.html": ("b.example.com", "/de/9.html", "example.com/de/", "block"), "https://q.org/fr/": ("q.org", "/fr/", "org/fr/", "allow"), "nothing": ("", "", None, None), None: ("", "", None, None),
        "http://badexample.com/de/1": ("badexample.com", "/de/1", None, None), "a://h?q=://z/p": ("h", "", None, None), "s://Ünix.org/a": ("Ünix.org", "/a", None, None),
    }
    rows = list(enumerate(cases)) + [(100 + i, f"http://big.example.com/{lang}/{i}") for i in range(60) for lang in ("de", "en")] + [(500 + i, f"http://o.net/de/{i}") for i in range(30)] + [(600, "http://d.com/" + "a/" * 50)] * 2
    df = spark.createDataFrame([(i, u, 1) for i, u in rows], "page_id long, url string, _node int")
    got = urls.judge(df).collect()
    assert len(got) == len(rows)
    first = {r["page_id"]: r for r in got}
    for i, want in enumerate(cases.values()):
        r = first[i]
        assert (r["host"], r["path"], r["rule"]) == want[:3] and (want[3] is None or r["verdict"] == want[3])
    assert {r["verdict"] for r in got if r["page_id"] >= 100 and r["host"] == "big.example.com" and "/de/" in r["path"]} == {"block"}
    assert len(first[600]["template"].split("/")) == 51
    assert urls.judge(df.limit(0)).count() == 0


def slow_judge(pages):
    """The tree, purities and verdicts in plain Python, from rows (page_id, host, path, rule, block or allow or None)."""
    rows = [{"id": i, "host": h, "seg": [x for x in path.split("/") if x], "known": v is not None, "block": v == "block", "v": v, "t": "", "s": ""} for i, h, path, _, v in pages]
    smooth = lambda b, n, by: (b + urls.WEIGHT * by) / (n + urls.WEIGHT)
    base = sum(r["block"] for r in rows) / max(1, sum(r["known"] for r in rows))
    for r in rows:
        at = [x for x in rows if x["host"] == r["host"]] if "q" not in r else []
        for x in at:
            x["q"] = smooth(sum(y["block"] for y in at), sum(y["known"] for y in at), base)
    level = 0
    while len(deep := [r for r in rows if len(r["seg"]) > level]) >= urls.OWN_PAGES:
        by = {}
        for r in deep:
            by.setdefault((r["host"], r["t"]), {}).setdefault(r["seg"][level], []).append(r)
        over = Counter(r["seg"][level] for r in deep)
        for children in by.values():
            whole = sum(map(len, children.values()))
            kept, names = {}, {}
            for x, at in children.items():
                k = sum(r["known"] for r in at)
                if over[x] >= max(urls.OWN_PAGES, urls.ALL_SHARE * len(deep)) or k >= urls.OWN_LABELLED or (len(at) >= urls.OWN_PAGES and len(at) >= urls.OWN_SHARE * whole):
                    kept[x] = (sum(r["block"] for r in at), k)
            shares = {}
            for x, (b, k) in kept.items():
                if k:
                    shares.setdefault(b / k, []).append(x)
                else:
                    names[x] = x
            branch, last = [], None
            for share in [*sorted(shares), None]:
                n = None if share is None else (sum(kept[x][0] for x in shares[share]), sum(kept[x][1] for x in shares[share]))
                if last is not None:
                    alike = False
                    if n is not None:
                        pooled = (n[0] + last[1][0]) / (n[1] + last[1][1])
                        alike = abs(share - last[0]) <= urls.ALIKE * math.sqrt(pooled * (1 - pooled) * (1 / n[1] + 1 / last[1][1]))
                    if not alike:
                        branch.sort()
                        hashed = 0
                        for x in branch:
                            hashed ^= xxhash.xxh64_intdigest(x.encode(), 42)
                        name = "|".join(branch) if len(branch) <= urls.NAMED else f"{branch[0]}|+{len(branch) - 1}#{hashed:x}"
                        names |= dict.fromkeys(branch, name)
                        branch = []
                if n is not None:
                    branch += shares[share]
                last = (share, n)
            for x, at in children.items():
                for r in at:
                    r["t"], r["s"] = r["t"] + "/" + names.get(x, "*"), r["s"] + "/" + (x if x in names else "*")
            for t in {r["t"] for at in children.values() for r in at}:
                at = [r for v in children.values() for r in v if r["t"] == t]
                q = smooth(sum(r["block"] for r in at), sum(r["known"] for r in at), at[0]["q"])
                for r in at:
                    r["q"] = q
        level += 1
    for r in rows:
        r["t"], r["s"] = (r[k] + "/*" * max(0, len(r["seg"]) - level) for k in "ts")
    sums = {}
    for r in rows:
        for key in (("s", r["s"]), ("t", r["host"], r["t"])):
            b, n = sums.get(key, (0, 0))
            sums[key] = (b + r["block"], n + r["known"])
    out = []
    for r in rows:
        (sb, sn), (b, n) = sums["s", r["s"]], sums["t", r["host"], r["t"]]
        purity = smooth(b, n, smooth(sb, sn, r["q"]))
        out.append((r["id"], r["v"] or ("block" if purity >= urls.REJECT else "allow"), r["t"] or "/", round(purity, 9)))
    return sorted(out)


def test_url_trees_are_those_of_plain_python(spark, sf_dir):
    rng = random.Random(21)
    words = ["de", "en", "fr", "news", "shop", *[f"s{i}" for i in range(30)]]
    made = [(10_000 + i, f"http://{rng.choice(['m.example.com', 'n.example.com', 'p.org', 'q.net', 'r.com', 's.com'])}/" + "/".join(rng.choice(words) if rng.random() < 0.8 else str(rng.randrange(9999)) for _ in range(rng.choice([0, 1, 1, 2, 3, 5])))) for i in range(4000)]
    # many sections of like size, wholly blocked or wholly allowed by rules below them, and a deep path
    rules = (*urls.RULES, *[("block" if i % 2 else "allow", "big.com", f"/c{i}/a/") for i in range(40)])
    made += [(20_000 + 100 * i + j, f"http://big.com/c{i}/{'ab'[j % 2]}/{j}") for i in range(40) for j in range(30)] + [(30_000 + i, "http://deep.com" + "/x" * 25) for i in range(3)]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").unionByName(spark.createDataFrame(made, "page_id long, url string"))
    got = urls.judge(pages, rules).collect()
    want = slow_judge([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in got])
    assert sorted((r["page_id"], r["verdict"], r["template"], round(r["purity"], 9)) for r in got) == want
    sections = {(r["path"].split("/")[1], r["verdict"]) for r in got if r["host"] == "big.com"}
    assert sections == {(f"c{i}", "block" if i % 2 else "allow") for i in range(40)}  # unlabelled pages get their section's verdict


# 5 quality, 6 language ------------------------------------------------------------------------


def test_quality(spark):
    lake = "/root/testdata/sf0.1"
    rows = queries.op5_quality(spark, lake).join(spark.read.parquet(f"{lake}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97


def test_quality_network():
    net = quality.fit_network([(f"plain text number {i} is here.", 1) for i in range(40)] + [(f"SHOUT!! {i} LOUD!!", 0) for i in range(40)])
    long = "plain text is here. " * 20_000
    assert quality.scores(["plain text is here.", "SHOUT!! LOUD!!"], net)[0] > 0.5 > quality.scores(["SHOUT!! LOUD!!"], net)[0]
    assert quality.scores([long + "SHOUT!! LOUD!! SHOUT!!"], net)[0] < quality.scores([long], net)[0]  # the end of a long text counts
    assert quality.scores([None], net) == quality.scores([""], net)
    many = ["plain", None, "SHOUT!!", long, ""]
    assert np.allclose(quality.scores(many, net), [quality.scores([t], net)[0] for t in many])


def test_quality_scores_are_those_of_plain_loops():
    """Every filter over every second byte of the whole text, the greatest response of each, one logistic sum."""
    net = quality.fit_network([(f"plain text number {i} is here.", 1) for i in range(40)] + [(f"SHOUT!! {i} LOUD!!", 0) for i in range(40)])
    rng = random.Random(3)
    for text in ("", "a", "plain text is here", "".join(rng.choice("ab !T\né") for _ in range(2500)), "ha ha ha ha " * 20):
        data = text.encode()
        marks = [int(i >= 6 and any(i - lag >= 5 and data[i - 5 : i + 1] == data[i - 5 - lag : i + 1 - lag] for lag in range(1, 33))) if i >= 5 else 0 for i in range(len(data))]
        room = max(len(data), quality.WIDTH)
        room += (room - quality.WIDTH) % quality.STRIDE and 1
        data, marks = data + bytes(room + 1024 - len(data)), marks + [0] * (room + 1024 - len(marks))
        z = net.base
        for f in range(quality.FILTERS):
            best = 0.0
            for at in range(0, room + 8, quality.STRIDE):
                seen = np.concatenate([np.append(net.embed[data[at + i]], marks[at + i]) for i in range(quality.WIDTH)])
                best = max(best, float(seen @ net.filters[:, f]) + float(net.bias[f]))
            z += best * float(net.out[f])
        assert math.isclose(quality.scores([text], net)[0], 1 / (1 + math.exp(-max(-30, min(30, z)))), rel_tol=1e-3, abs_tol=1e-6), text[:20]


def test_quality_chunks_cover_every_window():
    data = np.frombuffer(bytes(random.Random(2).randrange(1, 256) for _ in range(5000)), np.uint8)
    chunks, _, first = quality._chunks([data, data[:3]])
    seen = {bytes(c[i : i + quality.WIDTH]) for c in chunks[: first[1]] for i in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)}
    assert all(bytes(data[i : i + quality.WIDTH]) in seen for i in range(0, 5000 - quality.WIDTH + 1, quality.STRIDE))


def test_filters_keep_columns(spark, documents, labels):
    d = docs(spark, ODD + [(100 + r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()])
    for kept in (langid.accept(d), quality.accept(d, labels, documents), simhash.keep_one_of_each(d), mixing.repeated(d)):
        assert kept.columns == d.columns and {r["_score"] for r in kept.select("_score").distinct().collect()} == {2.0}
    nothing = docs(spark, [])
    for kept in (langid.accept(nothing), quality.accept(nothing, labels.limit(0), nothing), simhash.keep_one_of_each(nothing), mixing.repeated(nothing)):
        assert kept.count() == 0


def test_language(spark):
    lake = "/root/testdata/sf0.1"
    rows = queries.op6_language_id(spark, lake).join(spark.read.parquet(f"{lake}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98


def test_language_field(spark, documents):
    field = langid.learn(documents)
    texts = [langid.words(r["text"]) for r in documents.limit(20).collect()] + [[], ["a"], ["b"] * 64, ["c"] * 65]
    for w, p in zip(texts, langid.label_words(texts, field), strict=True):
        assert p.shape == (len(w), len(field.labels))
        if w:  # the blocked passes are the plain ones
            want, _ = langid._forward_backward(langid._scores(field.weights, *langid._features(w))[None].astype(float), field.moves, field.start)
            assert np.abs(want[0] - p).max() < 1e-3
    # also where transitions can't be undone, and the first word must be of one language
    stuck = langid.Field(field.labels, field.weights, np.zeros_like(field.moves), np.arange(len(field.labels)) * 3.0)
    for w, p in zip(texts, langid.label_words(texts, stuck), strict=True):
        if w:
            want, _ = langid._forward_backward(langid._scores(field.weights, *langid._features(w))[None].astype(float), stuck.moves, stuck.start)
            assert np.abs(want[0] - p).max() < 1e-3
    odd = {(r["doc_id"], r["text"]): (r["_l"]["lang_pred"], r["_l"]["score"]) for r in langid.predict(docs(spark, ODD), field, out_col="_l").collect()}
    assert odd[(1, None)] == odd[(2, "")] == odd[(4, "12 34 !!")] == ("und", 0.0)
    assert langid.predict(docs(spark, ODD), langid.fit_field([])).select("_lang.lang_pred").distinct().collect()[0][0] == "und"


# 7 mixing -------------------------------------------------------------------------------------


def targets_by_hand(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, target = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in target]
        rate = (total - sum(target.values())) / max(1e-9, sum(weights[s] for s in free)) if free else 0
        over = [s for s in free if weights[s] * rate >= 2 * sizes[s]]
        if not over:
            return target | {s: weights[s] * rate for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark, documents):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]
    d = docs(spark, rows + [(10_000 + i, "one two three four", "en", None) for i in range(40)] + [r for r in ODD if len(r[1] or "") < 1000])
    got = mixing.mix(d).collect()
    sizes, taken, told = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        told[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = targets_by_hand(sizes)
    assert len(got) == d.count() and sizes[None] == 160
    for s, t in want.items():
        assert math.isclose(told[s], t, rel_tol=1e-9) and abs(taken[s] - t) <= max(30, 0.05 * t), (s, t, taken[s])  # a source has ten documents here
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(d.repartition(3)).collect()))
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [(1, None, "en", None)])).first()["taken"] == 0


def test_mixing_comes_near_its_targets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = mixing.mix(documents).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("taken"), F.max("source_size").alias("size")).collect()
    want = targets_by_hand({r["source"]: r["size"] for r in got})
    for r in got:
        assert math.isclose(r["t"], want[r["source"]], rel_tol=1e-9) and abs(r["taken"] - r["t"]) <= 0.001 * r["t"], r


def test_mixing_rounds_as_plain_python_does(spark, documents):
    got = mixing.mix(documents).withColumn("_h", F.xxhash64("doc_id", "size", "text_hash")).collect()
    count, buckets, unit = Counter(r["source"] for r in got), {}, 10**9
    for r in got:
        buckets.setdefault((r["source"], (r["_h"] >> 20) % -(-count[r["source"]] // mixing.BUCKET)), []).append(r)
    for rows in buckets.values():
        rows.sort(key=lambda r: (-r["size"], r["_h"], r["doc_id"]))
        passed, copies = 0, {}
        for r in rows:
            u = round(r["rate"] * unit)
            before, passed = passed, passed + u
            copies[r["doc_id"]] = min(2, max(0, (passed + unit // 2) // unit - (before + unit // 2) // unit))
        lack = round(sum(round(r["rate"] * unit) * r["size"] for r in rows) / unit) - sum(copies[r["doc_id"]] * r["size"] for r in rows)
        spent = 0
        for r in sorted(rows, key=lambda r: (r["size"], r["_h"], r["doc_id"])):
            n = copies[r["doc_id"]]
            if r["size"] and (n < 2 if lack > 0 else n > 0 if lack < 0 else False):
                spent += r["size"]
                if spent - r["size"] / 2 <= abs(lack):
                    copies[r["doc_id"]] += 1 if lack > 0 else -1
        assert copies == {r["doc_id"]: r["copies"] for r in rows}


def test_mixing_of_repeated_and_missing_ids(spark, monkeypatch):
    rows = [(None, "one two three " * (i % 7 + 1), "en", "ab"[i % 2]) for i in range(300)] + [(5, f"text number {i}", "en", "a") for i in range(50)]
    kept = mixing.repeated(docs(spark, rows)).groupBy("doc_id", "text").count().collect()
    assert sum(r["count"] for r in kept if r["doc_id"] is None) > 200 and len({r["text"] for r in kept if r["doc_id"] == 5}) > 20
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        mixing.mix(docs(spark, rows)).count()


def test_mixing_of_thousands_of_equal_rows(spark):
    """Rows alike in id and text are dealt to many buckets, and their source comes near its target all the same."""
    rows = [(None, "always the same four", "en", "a")] * 6000 + [(3, "one two", "en", "a")] * 2000 + [(i, "some words " * (i % 9), "en", "b") for i in range(500)]
    parts = mixing._apart(mixing.sized(docs(spark, rows)))
    assert parts.count() == len(rows) and parts.filter("doc_id is null").groupBy("_h").count().agg(F.max("count")).first()[0] == mixing.ALIKE
    got = mixing.mix(docs(spark, rows)).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows).repartition(7)).collect()))


def test_mixing_rates_balance(spark):
    """The multipliers make the expected words equal the targets."""
    h = spark.createDataFrame([("a", s, n) for s, n in ((10, 50), (100, 20), (900, 3))] + [(None, 5, 7)], "source string, size long, n long")
    t = spark.createDataFrame([("a", 5200, 4000.0), (None, 35, 70.0)], "source string, source_size long, target double")
    for r in mixing.rates(h, t).collect():
        if not r["full"]:
            got = sum(n * s * 2 / (1 + math.exp(-r["tilt"] * s / r["scale"])) for s, n in ((10, 50), (100, 20), (900, 3)))
            assert abs(got - 4000) < 1e-3


# 8 embeddings ---------------------------------------------------------------------------------


def vectors(seed, n, width, groups):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, width))
    return (base[rng.integers(0, groups, n)] + rng.normal(size=(n, width)) * rng.choice([0.05, 0.25, 0.33], n)[:, None]).astype(np.float32)


@pytest.mark.parametrize("reach", [None, embeddings.REACH])
def test_embeddings(spark, reach):
    x = vectors(4, 700, 24, 90)
    x[5] = x[3] * 2
    rows = [(i, [float(v) for v in row], 1, "c") for i, row in enumerate(x)] + [(700 + i, [float(v) for v in x[9]], 1, "c") for i in range(20)]
    odd = [(800, None, 1, "c"), (801, [0.0] * 24, 1, "c"), (802, [float("nan")] * 24, 1, "c"), (803, [None] + [1.0] * 23, 1, "c"), (804, [float("inf")] * 24, 1, "c"), (805, [], 1, "c"), (None, [float(v) for v in x[1]], 1, "c")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, cell string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_components(df, per_cell=25, reach=reach).collect()}
    m = np.array([r[1] for r in rows], dtype=float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    linked = m @ m.T >= 0.9
    np.fill_diagonal(linked, False)
    ids = [r[0] for r in rows]
    found, there = sum(got[i][0] for i in ids), linked.sum()
    if reach is None:
        assert [got[i][0] for i in ids] == linked.sum(1).tolist()
        assert [got[i][1] for i in ids] == smallest_reachable(ids, linked).tolist()
    else:
        assert there * 0.98 <= found <= there and all(got[i][0] <= n for i, n in zip(ids, linked.sum(1), strict=True))
    assert all(got[i] == (0, i, True) for i in range(800, 806)) and len(got) == len(rows) + len(odd)
    assert embeddings.near_components(df.limit(0)).count() == 0


def test_embeddings_in_few_components(spark):
    """Every pair is found where offsets lie in few of the components."""
    x = np.zeros((600, 64))
    x[:, :3] = np.random.default_rng(11).normal(size=(600, 3))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_components(df, per_cell=25).collect()}
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = m @ m.T >= 0.9
    np.fill_diagonal(linked, False)
    assert [got[i] for i in range(600)] == list(zip(linked.sum(1).tolist(), smallest_reachable(list(range(600)), linked).tolist(), strict=True))


def test_embeddings_with_few_strong_directions(spark):
    """Vectors of 256 components whose spread falls off as those of learned embeddings does: no pair is missed, in 30 cells and more."""
    rng = np.random.default_rng(17)
    strength = 1 / np.arange(1, 257) ** 1.2
    base = rng.normal(size=(120, 256)) * strength
    x = base[rng.integers(0, 120, 900)] + rng.normal(size=(900, 256)) * strength * rng.choice([0.1, 0.3, 0.5], 900)[:, None]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_components(df, per_cell=25).collect()}
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = m @ m.T >= 0.9
    np.fill_diagonal(linked, False)
    assert linked.sum() > 1000
    assert [got[i] for i in range(900)] == list(zip(linked.sum(1).tolist(), smallest_reachable(list(range(900)), linked).tolist(), strict=True))


def test_embeddings_in_many_blocks(spark, monkeypatch):
    """Pairs within a block, between blocks of a cell and of different cells, of which tasks sum up what they found now and then; copies among them."""
    monkeypatch.setattr(embeddings, "BLOCK", 4096)
    monkeypatch.setattr(embeddings, "GATHERED", 50)
    x = vectors(8, 900, 24, 60)
    x[100:140] = x[7]
    x[300:520] = x[301] + np.random.default_rng(9).normal(size=(220, 24)) * 0.05  # a cell of several blocks
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_components(df, per_cell=25).collect()}
    m = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = m @ m.T >= 0.9
    np.fill_diagonal(linked, False)
    assert [got[i] for i in range(900)] == list(zip(linked.sum(1).tolist(), smallest_reachable(list(range(900)), linked).tolist(), strict=True))


def test_embeddings_nearest_to_the_limit():
    """Pairs nearer to the limit than single precision can tell are decided in double precision."""
    rng = np.random.default_rng(23)
    x, y = (embeddings._unit(rng.normal(size=(500, 48))) for _ in range(2))
    y = embeddings._unit(y - (x * y).sum(1, keepdims=True) * x)
    cos = 0.9 + rng.choice([-1e-3, -1e-6, -1e-8, -1e-12, 1e-12, 1e-8, 1e-6, 1e-3], 500)
    y = cos[:, None] * x + np.sqrt(1 - cos**2)[:, None] * y
    none = np.zeros(500, np.float32)
    found = [p for i, j in embeddings._near((x, x.astype(np.float32)), (y, y.astype(np.float32)), none, none, 1.0, 0.9) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert sorted(found) == [(i, i) for i in range(500) if cos[i] >= 0.9]


def test_embeddings_are_not_copied_for_cells(spark):
    """What is shuffled is a few times the vectors, whatever the number of cells that a vector's partners could be in."""
    written = lambda: spark._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    x = np.random.default_rng(31).normal(size=(1500, 128)).astype(np.float32)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    before = written()
    assert embeddings.near_components(df, per_cell=25).filter("kept and n_links = 0").count() == 1500
    spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    assert x.nbytes < written() - before < 4 * x.nbytes


# 9 simhash ------------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, documents):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]
    d = docs(spark, rows + [(10_000 + i, t, a, b) for i, t, a, b in rows[:9]] + [(20_000 + (i or 0), t, a, b) for i, t, a, b in ODD])
    found = simhash.near_components(simhash.fingerprints(d)).withColumn("fp", simhash.hex_fingerprint(["f0"])).collect()
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert all(int(r["fp"], 16) == prints[r["doc_id"]] and len(r["fp"]) == 16 for r in found)
    ids = sorted(prints)
    linked = np.array([[bin(prints[a] ^ prints[b]).count("1") <= 3 for b in ids] for a in ids])
    want = dict(zip(ids, smallest_reachable(ids, linked).tolist(), strict=True))
    assert all(r["component_id"] == want[r["doc_id"]] for r in found)


def test_simhash_tiles(spark, monkeypatch):
    """Many tiles and blocks give the links of one comparison of everything."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in np.repeat(base, 5)]
    lanes = np.array(flips, dtype=np.uint64)
    monkeypatch.setattr(simhash, "LEAST_TILE", 40)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lanes.view(np.int64))], "doc_id long, f0 long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(df).collect()}
    linked = np.bitwise_count(lanes[:, None] ^ lanes[None, :]) <= 3
    assert [got[i] for i in range(len(lanes))] == smallest_reachable(list(range(len(lanes))), linked).tolist()


def test_near_copies_go(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    originals = [[word() for _ in range(200)] for _ in range(30)]
    near = [w[:50] + ["changed"] + w[51:120] + ["twice"] + w[121:] for w in originals]
    rows = [(i, " ".join(w), "en", "a") for i, w in enumerate(originals)] + [(100 + i, " ".join(w), "en", "a") for i, w in enumerate(near)] + [(200, " ".join(originals[0]), "en", "a")]
    assert sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows)).collect()) == list(range(30))


def test_near_copies_are_checked(spark):
    """Links are those of a similarity of 0.8 or more, whatever the fingerprints say; rows go one by one."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows, want = [], set()
    for at, share in enumerate([0.6, 0.7, 0.75, 0.79, 0.8, 0.81, 0.85] * 12):
        a = [word() for _ in range(364)]
        # 360 shingles, of which the last are others: (360 - n) / (360 + n)
        n = round(360 * (1 - share) / (1 + share)) if share != 0.8 else 40
        b = a[: 364 - n] + [word() for _ in range(n)]
        x, y = (set(zip(*[w[i:] for i in range(5)], strict=False)) for w in (a, b))
        rows += [(10 * at, " ".join(a), "en", "a"), (10 * at + 1, " ".join(b), "en", "a")]
        want |= {10 * at} | ({10 * at + 1} if len(x & y) / len(x | y) < 0.8 else set())
    got = sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows)).collect())
    assert got == sorted(want)
    # the same id with another text stays, whole repeated rows don't
    again = [rows[0], rows[0], (10, "a text that is nowhere else in this table at all", "en", "a"), rows[2], (10, rows[0][1], "en", "a")]
    left = [(r["doc_id"], r["text"]) for r in simhash.keep_one_of_each(docs(spark, again)).collect()]
    assert sorted(left) == sorted([rows[0][:2], again[2][:2], rows[2][:2]])


def test_near_copies_of_documents_are_those_of_all_pairs(spark, documents):
    """On the test table: of each group of texts linked by a similarity of 0.8 of their five-word shingles one stays."""
    rows = sorted((r["doc_id"], (r["text"] or "").lower().split()) for r in documents.collect())
    runs = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for _, w in rows]
    linked = np.array([[len(a & b) >= 0.8 * len(a | b) for b in runs] for a in runs])
    got = sorted(r["doc_id"] for r in simhash.keep_one_of_each(documents).collect())
    want = sorted(set(smallest_reachable([i for i, _ in rows], linked).tolist()))
    assert got == want and len(want) < len(rows)


def test_short_texts_that_share_words_stay(spark):
    """Lines of five to eight words that share most of them are below a similarity of 0.8, but for case and space."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    texts = []
    for _ in range(25):
        w = [word() for _ in range(8)]
        texts += [" ".join(w[:5]), " ".join(w[:6]), " ".join([word(), *w[:5]]), " ".join(w[:7]), " ".join(w), " ".join(w[:7] + [word()])]
    got = sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts + [texts[0].upper() + " "])])).collect())
    assert got == list(range(len(texts)))


def test_large_groups_are_dealt(spark, monkeypatch):
    """Blocks of a large group of candidates give the groups of one comparison of everything."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    rows = []
    for i in range(150):
        w = base[: rng.randrange(48, 61)]
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"other{i}"
        rows.append((i, " ".join(w), "en", "a"))
    sets = [set(zip(*[t.split()[i:] for i in range(5)], strict=False)) for _, t, *_ in rows]
    linked = np.array([[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets])
    monkeypatch.setattr(simhash, "SHINGLES", 400)
    got = sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows), lanes=2, radius=64).collect())
    assert got == sorted(set(smallest_reachable(list(range(150)), linked).tolist()))


@pytest.mark.parametrize("length", [14, 20, 30, 60, 300])
def test_candidates_at_the_least_similarity(length):
    """Of pairs with a similarity of 0.80 to 0.83 of their five-word shingles hardly any differs in more than 36 and 40 of 128 bits."""
    rng = random.Random(length)
    pairs = near = 0
    while pairs < 400:
        a = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        b = list(a)
        for _ in range(rng.randint(1, 2 + length // 30)):
            at = rng.choice([0, length - 1, rng.randrange(length)])
            b[at : at + 1] = rng.choice([[], [f"v{rng.randrange(10**6)}"]])
        x, y = (set(zip(*[t[i:] for i in range(5)], strict=False)) for t in (a, b))
        if 0.8 <= len(x & y) / len(x | y) <= 0.83:
            f, g = (np.array(simhash.fingerprint(" ".join(t), 5, 4, settle=True, once=True), dtype=np.int64).view(np.uint64) for t in (a, b))
            pairs += 1
            apart = np.bitwise_count(f ^ g)
            near += apart[:2].sum() <= 36 and apart[2:].sum() <= 40
    assert near >= 0.99 * pairs


def test_lanes_are_independent():
    """Unrelated texts differ in half of all bits, with the deviation of fair coins, and lanes agree no more than by chance."""
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(400)]
    lanes = np.array([simhash.fingerprint(t, 5, 4, settle=True, once=True) for t in texts], dtype=np.int64).view(np.uint64)
    apart = np.bitwise_count(lanes[:, None] ^ lanes[None, :]).astype(int)[np.triu_indices(400, 1)]
    assert abs(apart.sum(1).mean() - 128) < 1 and abs(apart.sum(1).std() - 8) < 0.5 and apart.sum(1).min() > 80
    assert np.abs(np.corrcoef(apart.T) - np.eye(4)).max() < 0.03


def test_short_texts_stay_apart():
    """Ties of two shingles don't make unrelated texts alike."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(6)) for _ in range(300)]
    lanes = np.array([simhash.fingerprint(t, 5, 2, settle=True) for t in texts], dtype=np.int64).view(np.uint64)
    apart = np.bitwise_count(lanes[:, None] ^ lanes[None, :]).sum(2)[np.triu_indices(300, 1)]
    assert 63 < apart.mean() < 65 and apart.min() > 34


# 10 licences ----------------------------------------------------------------------------------


def slow_passages(text, scanner):
    """The best coefficient of any run of words with each licence."""
    grams = licences._bigrams([w for w, _, _ in licences.normalised(text)])
    best = {}
    for (name, want), needs in zip(scanner.templates, scanner.needs):
        for i in range(len(grams)):
            for j in range(i + 1, len(grams) + 1):
                run = set(grams[i:j])
                dice = 2 * len(run & want) / (len(run) + len(want))
                if dice >= scanner.least and needs <= run:
                    best[name] = max(best.get(name, 0), dice)
    return best


def test_licences(spark):
    scanner = licences.Scanner()
    texts = ["intro words\nReleased under the MIT License.\nmore", "It is licensed under the apache licence, version 2.0, they say", "This work is licensed under the GNU General Public License, version 3.", "nothing of the kind here, not under any license", "", None, "Licensed under CC BY-NC 4.0. " * 50]
    names = [[n for n, *_ in scanner.passages(t)] for t in texts]
    assert names[0] == ["MIT"] and names[1] == ["Apache-2.0"] and names[2] == ["GPL-3.0"] and names[3] == names[4] == names[5] == [] and set(names[6]) == {"CC-BY-NC-4.0"}
    name, score, a, b = scanner.passages(texts[0])[0]
    assert texts[0][a:b] == "Released under the MIT License" and score == 1.0
    rng = random.Random(9)
    vocabulary = "licensed released under the mit apache license version 2.0 3 gnu general public work is this cc by-nc 4.0 a b".split()
    for _ in range(60):
        text = " ".join(rng.choice(vocabulary) for _ in range(25))
        want, got = slow_passages(text, scanner), scanner.passages(text)
        assert bool(want) == bool(got) and (not got or math.isclose(max(s for _, s, _, _ in got), max(want.values())))
    assert licences.scan(docs(spark, ODD)).filter(F.size("licences") > 0).count() == 0 and licences.scan(docs(spark, [])).count() == 0


def test_licences_of_one_family_are_told_apart():
    scanner = licences.Scanner()
    names = lambda t: [n for n, *_ in scanner.passages(t)]
    for name, texts in licences.TEMPLATES.items():
        for t in texts:
            assert names(f"Some words before.\n{t}\nAnd some after it.") == [name], t
    changed = licences.TEMPLATES["GPL-3.0"][1].replace("version 3", "version 2")
    assert names(changed) == ["GPL-2.0"] and names("Licensed under CC BY 2.0") == ["CC-BY-2.0"] and names("Licensed under CC BY 9.0") == [] and names("licensed under the apache license version 1.0") == []
    assert names(licences.TEMPLATES["MIT"][2].replace("Software", "Program")) in (["MIT"], [])


def test_common_headers_are_known():
    names = lambda t: [n for n, *_ in licences.Scanner().passages(t)]
    for line, name in (("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"), ("// SPDX-License-Identifier: MIT OR Apache-2.0", "MIT")):
        assert names(f"words before\n{line}\nint main") == [name]
    assert names("SPDX-License-Identifier: Unheard-Of-1.0") == [] and names("the spdx-license-identifier tag") == []
    old = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    assert names(old) == ["GPL-2.0"] and names(old.replace("version 2", "version 3")) == ["GPL-3.0"]
    assert names("Distributed under the Boost Software License, Version 1.0. (See accompanying file)") == ["BSL-1.0"]


def test_numbers_of_items_are_no_versions():
    scanner = licences.Scanner()
    for body in (licences._BSD + licences._BSD_THIRD + licences._BSD_END, licences._ZLIB, licences._WTFPL):
        assert not licences._needs(body)
        bullets = re.sub(r"(?<=[.:N])\s\d\.", " *", body)
        assert bullets != body and {n for n, *_ in scanner.passages(bullets)} == {n for n, *_ in scanner.passages(body)} != set()
    assert licences._needs("Licensed under Thing 2.0. All of it") == {("thing", "2.0"), ("2.0", "all")}


def test_licences_in_stretched_and_very_long_texts():
    scanner = licences.Scanner()
    stretched = "released under the " + "the " * 5000 + "mit license"
    (name, score, a, b), = scanner.passages(stretched)
    assert (name, a, b) == ("MIT", 0, len(stretched)) and math.isclose(score, 8 / 9)
    many = "Released under the MIT License. " * 4000
    began = time.time()
    assert len(scanner.passages(many)) == 4000 and time.time() - began < 20
    full = (licences.TEMPLATES["MIT"][2] + " x y z ") * 40
    assert [n for n, *_ in scanner.passages(full)] == ["MIT"] * 40


# pipeline -------------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir)
        assert after.columns == kept.columns, name
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        rows = after.collect()
        assert rows and {r["doc_id"] for r in rows} <= ids
        kept = spark.createDataFrame(rows, kept.schema)
    v = pieces.read_model(queries.PIECES)
    for r in corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).limit(50).collect():
        assert r["n_tokens"] == len(r["ids"]) and pieces.decode(r["ids"], v)
    assert corpus_pipeline.run(spark, sf_dir).count() == kept.count()


def test_language_fit_holds_little(monkeypatch):
    """What a fit allocates on the driver at most, for 84,000 characters of words that hardly repeat."""
    import tracemalloc

    rng = random.Random(3)
    texts = [(" ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(3000)), lang) for lang in ("da", "fi", "nl", "sv")]
    monkeypatch.setattr(langid, "ROUNDS", 2)
    tracemalloc.start()
    try:
        langid.fit_field(texts)
        assert tracemalloc.get_traced_memory()[1] < 24e6
    finally:
        tracemalloc.stop()
