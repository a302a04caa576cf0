"""Small tables against brute force: nulls, empty texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gritmill.functions.text import clean_split
from gritmill.llm import capping, encoding, leaks, overlap, pairs, ranking, sampling, sentences, splits
from gritmill.llm.words import edits_within, words

D = "/root/testdata/sf0.001/"


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def test_saved_tables_go(spark):
    from gritmill.llm import store

    df = spark.range(5)
    kept = store.saved(df)
    path = store._written[-1][1]
    assert kept.count() == 5
    assert store.clear_saved() == [] and not store._written
    with pytest.raises(Exception):
        spark.read.parquet(path)


# 1 ---------------------------------------------------------------------------------------------------------------
def test_capping(spark):
    rng = random.Random(1)
    rows = [(f"r{i}", rng.choice(["Big", "big ", "small", None, "!!"]), rng.choice([0.5, 0.5, 0.9, None, float("nan"), 7.0, -1.0])) for i in range(200)]
    rows += rows[:30] + [(None, "big", 0.9)]
    df = spark.createDataFrame(rows, "record_id string, source_id string, quality_score double").withColumn("rank", F.lit("x")).withColumn("allowed", F.lit(1))
    got = {r.identifier: r for r in capping.cap_contributors(df, capping.unified_contributor(), "record_id", "quality_score", 20).collect()}
    once = {a: (b, c) for a, b, c in rows if a is not None}
    limit, by = len(once) * 20 // 100, defaultdict(list)
    clean = lambda s: "_".join("".join(c if c.isalnum() else " " for c in s.lower()).split()) or None if s else None
    key = lambda q: round(q * 10000) if q is not None and 0 <= q <= 1 else -1
    for a, (b, c) in once.items():
        by[clean(b)].append((-key(c), md5(a), a))
    want = {x[2] for s, xs in by.items() for x in (sorted(xs) if s is None else sorted(xs)[:limit])}
    assert set(got) == want
    report = {r.contributor: r for r in capping.cap_report(df, capping.unified_contributor(), "record_id", "quality_score", 20).collect()}
    assert {s: r.n_records for s, r in report.items()} == {s: len(x) for s, x in by.items()}
    assert all(r.n_kept == min(limit, r.n_records) for s, r in report.items() if s is not None)
    assert capping.cap_contributors(df.limit(0), capping.unified_contributor(), "record_id", "quality_score", 20).count() == 0
    few = capping.cap_contributors(df, capping.unified_contributor(), "record_id", "quality_score", 100, max_count=3)
    assert few.where("contributor = 'big'").count() == 3


def test_salted_rank_is_a_rank(spark):
    rows = [(f"k{i}", i % 2, "g" if i % 3 else None) for i in range(300)]
    got = ranking.salted_rank(spark.createDataFrame(rows, "id string, q int, g string"), "g", "q", "id", hex_digits=1).collect()
    for g in ("g", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and all(r.group_rows == len(own) for r in own)
        assert [(-r.q, md5(r.id)) for r in own] == sorted((-r.q, md5(r.id)) for r in own)


# 2 ---------------------------------------------------------------------------------------------------------------
def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    groups = defaultdict(set)
    for x in list(parent):
        groups[find(x)].add(x)
    return {x: min(g) for g in groups.values() for x in g}


@pytest.mark.parametrize("shape", ["random", "path", "star", "empty"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "random": [(f"n{rng.randrange(80)}", f"n{rng.randrange(80)}") for _ in range(60)],
        "path": [(f"p{i:03}", f"p{i + 1:03}") for i in range(70)],
        "star": [("hub", f"s{i}") for i in range(50)] * 2,
        "empty": [],
    }[shape]
    got = {r.node: r.component for r in splits.components(spark.createDataFrame([*edges, (None, "x")], "a string, b string")).collect()}
    assert got == brute_components([e for e in edges if e[0] != e[1]])


def test_splits(spark):
    rows = [
        ("r1", "A feed", "cve-2020-0001", "train"), ("r2", "B", "CVE‑2020‑0001; CVE 2021 12345", " Test"), ("r3", "b ", None, None), ("r4", "c", "nan", "train"), ("r5", "C", "", "TRAIN"),
        ("r6", "", "", "val"), ("r7", None, None, "validation"), ("r1", "A feed", "cve-2020-0001", "train"), (None, "A feed", None, "val"), ("r8", "d", "CVE:2021-12345x", "val"),
    ]
    df = spark.createDataFrame(rows, "record_id string, source_id string, cve string, split string").withColumn("component", F.lit("clash"))
    moves = splits.split_moves(df, "record_id", splits.unified_entities(), splits.unified_split(), {"train": 1.0}).collect()
    found = {(r.group_kind, r.group_key): (r.splits, r.records, r.moves) for r in moves if len(r.splits) > 1}
    assert found == {("cve", "CVE-2020-0001"): (["test", "train"], 2, 1), ("cve", "CVE-2021-12345"): (["test", "val"], 2, 2)}
    assert len({r.component for r in moves if (r.group_kind, r.group_key) in found}) == 1
    done = {r.record: r for r in splits.assign_splits(df, "record_id", splits.unified_entities(), {"train": 0.5, "val": 0.25, "test": 0.25}).collect()}
    assert len(done) == 8 and len({done[r].component for r in ("r1", "r2", "r3", "r8")}) == 1 and done["r4"].component == done["r5"].component
    assert len({done[r].component for r in ("r1", "r4", "r6", "r7")}) == 4
    assert splits.assign_splits(df.limit(0), "record_id", splits.unified_entities(), {"train": 1.0}).count() == 0


def test_hash_split_shares(spark):
    got = Counter(r.s for r in spark.range(20000).select(splits.hash_split(F.col("id").cast("string"), {"train": 0.8, "val": 0.1, "test": 0.1}).alias("s")).collect())
    assert abs(got["train"] - 16000) < 300 and abs(got["val"] - 2000) < 200


# 3 ---------------------------------------------------------------------------------------------------------------
def test_pairs_on_planted_defects(spark):
    bench = spark.read.parquet(D + "gold_benchmark.parquet").select("record_id", "input_text", "expected_output")
    chats = spark.read.parquet(D + "sft_examples.parquet").select("example_id", "messages_json", "target_json")
    prompt = "The loader of Example 1.2 copies cached keys after login. Operators should move to the fixed build. The beacon drains the queue before the alarm is raised."
    planted = [
        ("x1", prompt, None, "empty"), ("x2", prompt, " \n", "empty"), ("x3", prompt, "N/A", "empty"), ("x4", prompt, "malicio", "truncated"), ("x5", prompt, "CVE-2021-", "truncated"),
        ("x6", prompt, "The record shows that the key was copied after the login and that the", "truncated"), ("x7", prompt, "I'm sorry, but I can't help with that.", "refusal"), ("x8", prompt, prompt.upper(), "copied"),
        ("x9", prompt, "Der Dienst meldet alle Schlüssel und die Sicherung ist nach dem Start nicht aktiv.", "other_language"), ("x10", prompt + " Answer in German.", "Der Dienst meldet alle Schlüssel und die Sicherung ist nach dem Start nicht aktiv.", None),
        ("x11", prompt, "unknown", None), ("x12", prompt, "CVE-2021-12345", None), ("x13", prompt, "The service is unable to start, so the record describes an outage.", None), ("x14", None, "benign", None), (None, prompt, "", None),
    ]
    extra = spark.createDataFrame([p[:3] for p in planted], "record_id string, input_text string, expected_output string")
    bad_chat = spark.createDataFrame(
        [("c1", None, None), ("c2", '[{"role": "user", "content": "hi"}]', '{"answer": "benign"}'), ("c3", '[{"role": "user", "content": "hi"}, {"role": "assistant", "content": "{\\"answer\\": \\"benign\\"}"}]', '{"answer": "benign'), ("c4", "[]", "[]")],
        "example_id string, messages_json string, target_json string",
    )
    rows = pairs.defective(bench.unionByName(extra).unionByName(extra).withColumn("defect", F.lit("clash")), chats.unionByName(bad_chat)).collect()
    assert len({(r.table_name, r.row_key) for r in rows}) == len(rows)
    got = {r.row_key: r.defect for r in rows}
    assert {k: got.get(k) for k, *_ in planted if k} == {k: d for k, _, _, d in planted if k}
    assert [got.get(c) for c in ("c1", "c2", "c3", "c4")] == ["empty", "empty", "truncated", "empty"]


@pytest.fixture(scope="module")
def pair_model():
    rows = pd.read_parquet(D + "gold_benchmark.parquet", columns=["input_text", "expected_output"])
    chats = pd.read_parquet(D + "sft_examples.parquet", columns=["messages_json", "target_json"])
    return pairs.train([pairs.benchmark_pair(a, b) for a, b in rows.itertuples(index=False)] + [p for a, b in chats.itertuples(index=False) for p in pairs.chat_pairs(a, b)])


#: Wordings that no template can give.
UNSEEN = {
    "refusal": [
        "That falls outside what I'm prepared to discuss.", "I'd rather not get into that.", "I'm afraid that isn't something I can do.", "This isn't a topic I engage with.", "I have no intention of answering.", "Nope, not answering that.",
        "Providing an assessment would be against company policy.", "My instructions prevent me from labelling this entry.", "I am restricted from commenting.", "For safety reasons this will remain unanswered.", "Regretfully, assistance is not possible.",
        "We do not provide such information.", "I'm only able to help with harmless questions.", "I'm programmed not to respond to this.", "Non posso aiutarti con questa richiesta.", "Nie mogę odpowiedzieć na to pytanie.", "Ich bin nicht befugt, darauf zu antworten.",
        "Je regrette, mais il m'est interdit de répondre.", "No me es posible atender esta petición.", "Мне не разрешено давать такой ответ.", "恕我不能回答。", "لا يمكنني تقديم المساعدة هنا.", "मैं इस अनुरोध को पूरा नहीं कर सकता।", "ไม่สามารถช่วยได้ค่ะ",
    ],
    "other_language": [
        "Lo script di installazione scrive nella cartella temporanea senza verificare la firma.", "Skrypt instalacyjny zapisuje pliki w katalogu tymczasowym bez sprawdzania podpisu.", "설치 프로그램이 서명을 확인하지 않고 임시 폴더에 파일을 쓴다.",
        "Het installatiescript schrijft bestanden in de tijdelijke map zonder de handtekening te controleren.", "O instalador grava ficheiros na pasta temporária sem verificar a assinatura.", "Το πρόγραμμα γράφει αρχεία σε προσωρινό φάκελο.",
    ],
    "truncated": ["The loader copies the cached keys and then", "ai_security_", "CWE-", "T10", "CVE-2021-12", "vulnerable_depend", "Operators should move to the fixed build, because", "malicious_pack"],
    "empty": ["", " ", "N/A", "none", "—", "[]", "{ }", "...", "NULL", "​"],
}


def test_unseen_wordings(pair_model):
    prompt = pairs.Prompt(*["The loader of Example 1.2 copies cached keys after login. Operators should move to the fixed build. The beacon drains the queue before the alarm is raised."] * 3)
    for defect, answers in UNSEEN.items():
        found = pair_model.defects([pairs.Pair(prompt, a) for a in answers])
        assert sum(d == defect for d in found) >= 0.9 * len(answers), (defect, list(zip(answers, found)))
    fine = ["benign", "ai_security_risk", "CVE-2021-12345", "T1059.003", "unknown", "The service is unable to start after the change, so the record describes an outage as well.", "I can see two causes in the record, and both are local.", "The loader copies keys of the host, and nobody is alerted."]
    assert pair_model.defects([pairs.Pair(prompt, a) for a in fine]) == [None] * len(fine)
    han = "密钥服务在登录之前删除了失效的证书。伪造的登录页面复制了签名密钥。"
    assert pair_model.defects([pairs.Pair(pairs.Prompt(han, han, han), han[:-4]), pairs.Pair(prompt, prompt.record[10:]), pairs.Pair(prompt, "S10")]) == ["copied", "copied", "truncated"]
    asked = pairs.Prompt(prompt.text + " Use Italian for the answer.", prompt.record, prompt.instruction)
    assert pair_model.defects([pairs.Pair(asked, UNSEEN["other_language"][0])]) == [None]


def test_pairs_empty_tables(spark):
    a = spark.createDataFrame([], "record_id string, input_text string, expected_output string")
    b = spark.createDataFrame([], "example_id string, messages_json string, target_json string")
    assert pairs.defective(a, b).count() == 0


# 4 ---------------------------------------------------------------------------------------------------------------
def test_overlap_equals_brute_force(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 70))] for _ in range(40)]
    base.append([f"w{rng.randrange(200)}" for _ in range(1500)])
    rows = []
    for i, w in enumerate(base):
        for j in range(3):
            v = list(w)
            for _ in range(rng.randrange(0, len(w) // 6 + 2)):
                at = rng.randrange(len(v) + 1)
                v[at : at + rng.randrange(0, 2)] = [f"x{rng.randrange(9)}"][: rng.randrange(0, 2)]
            text = " ".join(v)
            text = rng.choice([text, text.upper(), text.replace(" ", " , "), "​" + text, text.replace("w", "ｗ")])
            rows.append((f"r{i}_{j}", f"s{j}", rng.choice(["train", "Test", "validation ", None]), text))
    rows += [("empty", "s", "train", ""), ("blank", "s", "test", " . "), ("null", "s", "test", None), (None, "s", "test", rows[0][3])]
    df = spark.createDataFrame(rows + rows[:10], "record_id string, source_id string, split string, normalized_text string").withColumn("tokens", F.lit("clash"))
    found, members = overlap.overlaps(df, "record_id", "normalized_text", clean_split("split"), "source_id")
    got = {(r.e_record, r.t_record) for r in overlap.record_pairs(found, members).collect()}
    side = {"train": "t", "Test": "e", "validation ": "e"}
    own = [(a, side[c], words(d)) for a, _, c, d in rows if a and c and d and words(d)]
    want = {(a, b) for a, s, x in own for b, t, y in own if s == "e" and t == "t" and edits_within(x, y, max(len(x), len(y)) // 8)}
    assert got == want and len(want) > 10
    counts = {r.record: r.pairs for r in overlap.evaluation_counts(found, members).collect()}
    assert counts == Counter(a for a, _ in want)
    listed = overlap.class_members(found, members).collect()
    assert {r.record for r in listed} == {a for a, *_ in own} and {r.record for r in listed if r.links} == {x for pair in want for x in pair}
    twice = spark.createDataFrame([("a", "s", "train", "one two three"), ("a", "s", "train", "four five six"), ("b", "s", "test", "four five six")], df.drop("tokens").schema)
    assert [(r.e_record, r.t_record) for r in overlap.record_pairs(*overlap.overlaps(twice, "record_id", "normalized_text", clean_split("split"), "source_id")).collect()] == [("b", "a")]
    # the automata alone, over all texts and without any routing, find the same; so do several shards and salts
    rows_ = overlap.normalise(df, "record_id", "normalized_text", clean_split("split"), "source_id").cache()
    classes = lambda side: rows_.where(F.col("side") == "train" if side else F.col("side") != "train").groupBy("cid", "cid2").agg(F.min("tokens").alias("tokens"))
    keys = lambda d: {(r.e_cid, r.t_cid) for r in d.collect()}
    for shards, salts in ((1, 1), (3, 2)):
        everywhere = classes(True).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.col("cid").alias("t_cid"))
        assert keys(overlap.scanned(everywhere, classes(False), classes(True), shards, salts)) == keys(found)
    none, rest = overlap.overlaps(df.limit(0), "record_id", "normalized_text", clean_split("split"), "source_id")
    assert overlap.record_pairs(none, rest).count() == 0


def test_runs_are_disjoint_and_enough():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in [*range(1, 120), 447, 448, 449, 460, 1000, 5000]:
        length = overlap.run_length(n)
        at = overlap.choose_runs(rng.random(n - length + 1), n, length)
        assert len(at) >= n // 7 + 1 or n < 8 and len(at) >= 1
        assert all(b - a >= length for a, b in itertools.pairwise(at)) and at[0] >= 0 and at[-1] + length <= n


# 6 ---------------------------------------------------------------------------------------------------------------
def test_sampling(spark):
    rows = [(f"r{i}", c) for c, n in (("Big  One", 500), ("big one", 300), ("Small", 4), ("Rare", 1), (None, 9), ("Other", 50)) for i in range(n) for i in [f"{c}{i}"]]
    rows += rows[:50] + [(None, "Small")]
    df = spark.createDataFrame(rows, "record_id string, main_category string").withColumn("key", F.lit("clash"))
    targets = spark.createDataFrame(
        [(1, "main_category", "big one", 0.5, 1, 100), (2, "main_category", "SMALL", 0.01, 3, 100), (3, "main_category", "rare", 0.3, 2, 100), (4, "main_category", "gone", 0.19, 0, 100)],
        "target_id long, dimension string, category string, target_share double, min_rows int, sample_size long",
    )
    people = sampling.population(df, "record_id", {"main_category": "main_category"})
    got = Counter(r.category for r in sampling.sample(people, targets).collect())
    # rare and gone leave 48 rows to the others, floors come out of the largest category
    assert got == {"big one": 96, "SMALL": 3, "rare": 1}
    assert sampling.sample(people, targets).distinct().count() == 100
    report = {r.category: r for r in sampling.report(people, targets).collect()}
    assert {c: (r.available, r.selected, r.capped, r.below_floor) for c, r in report.items()} == {
        "big one": (800, 96, False, False), "SMALL": (4, 3, False, False), "rare": (1, 1, True, True), "gone": (0, 0, True, False),
    }
    assert sampling.sample(people, targets, "7").subtract(sampling.sample(people, targets)).count() > 0
    assert sampling.sample(people.limit(0), targets).count() == 0 and sampling.report(people.limit(0), targets).count() == 4


def test_sample_sizes_stay():
    """Random targets: the size is the wanted one wherever the rows allow it, shares and floors hold."""
    rng = random.Random(66)
    for _ in range(300):
        k = rng.randrange(1, 9)
        have = [rng.choice([0, 1, 3, 40, 500, 2000]) for _ in range(k)]
        share = [rng.random() for _ in range(k)]
        rows = pd.DataFrame({"key": [f"k{i}" for i in range(k)], "target_id": range(k), "dimension": "d", "category": "c", "wanted": [100 * x / sum(share) for x in share], "floor_rows": [rng.choice([0, 0, 2, 5]) for _ in range(k)], "available": have})
        got = sampling._plan_dimension(rows, rng.random())
        assert (got.final <= got.available).all() and (got.final >= got[["floor_rows", "available"]].min(axis=1)).all()
        if sum(have) >= 120:
            assert 99 <= got.final.sum() <= max(101, sum(min(a, b) for a, b in zip(rows.floor_rows, have)))
        free = got[(got.p < 1) & (got.available > 0)]
        if got.floor_rows.sum() == 0 and len(free):
            assert (free.final - free.p * free.available).abs().max() <= 1 and (free.p * free.available >= free.wanted - 1e-6).all()


# 8 ---------------------------------------------------------------------------------------------------------------
def test_encoding(spark):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    reference.encode_special_tokens = True
    rng = random.Random(8)
    alphabet = ["'", "s", "t", "re", "ve", "ll", " ", "\n", "\t", "7", "é", "中", "!", "-", "\xa0", "　", "😀", "́", "\x00", "S", "<|endoftext|>", "½", "٣", "\x85", "​"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(3000)] + [None, "", "  ", "a" * 20000, "x", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    coder = encoding.encoder(encoding.DEFAULT_VOCABULARY)
    got = {r.doc_id: r for r in encoding.encode_corpus(df, "doc_id", "text", offsets=True).collect()}
    for i, t in enumerate(texts):
        assert list(got[i].ids) == reference.encode(t or "", add_special_tokens=False).ids, repr(t)
        assert coder.decode(got[i].ids) == (t or "")
        starts = [*got[i].slice_starts, len(t or "")]
        at = 0
        for a, b, n in zip(starts, starts[1:], got[i].slice_sizes):
            assert coder.decode(got[i].ids[at : at + n]) == t[a:b]
            at += n
    assert encoding.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


# 9 ---------------------------------------------------------------------------------------------------------------
def test_leaks(spark):
    rng = random.Random(9)
    item = [f"unit{rng.randrange(400)}" for _ in range(80)]
    han = "".join(chr(0x4E00 + rng.randrange(500)) for _ in range(120))
    noise = lambda n: " ".join(f"noise{rng.randrange(400)}" for _ in range(n))
    half = item[20:62]
    edited = [w if i % 14 else "other" for i, w in enumerate(half)]
    wrong = [w if i % 5 else "other" for i, w in enumerate(half)]
    docs = [
        (1, f"{noise(50)} {' '.join(item)} {noise(9)}"), (2, f"{noise(7)} <b>{'</b>, <i>'.join(half)}</i>"), (3, f"> {' '.join(edited).upper()}"), (4, f"{noise(30)} {' '.join(wrong)}"),
        (5, " ".join(item[:30])), (6, None), (7, ""), (8, "、".join(han[30:100])), (9, han[:40]), (10, f"{noise(4)} {' '.join(half)[:100]}-\n{' '.join(half)[100:]}"), (1, " ".join(item)),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(70, " ".join(item)), (71, han), (72, None), (73, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(df, "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {(1, 70), (2, 70), (3, 70), (8, 71), (10, 70)}
    assert leaks.find_leaks(df, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0
    assert leaks.find_leaks(df.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0


def test_leak_recall(spark):
    """Every pair with an exact alignment among those that share enough runs is found."""
    import numpy as np

    items, docs = pd.read_parquet(D + "eval_items.parquet"), pd.read_parquet(D + "documents.parquet").dropna(subset=["text"])
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(spark.read.parquet(D + "documents.parquet"), "doc_id", "text", spark.read.parquet(D + "eval_items.parquet"), "item_id", "text").collect()}
    hashes, want = leaks.WordHashes(), set()
    for by_character in (False, True):
        own = [(k, hashes(leaks.units(t, by_character))) for k, t in zip(items.item_id, items.text) if leaks.is_by_character(t) == by_character]
        for k, t in zip(docs.doc_id, docs.text):
            h = hashes(leaks.units(t, by_character))
            want |= {(k, i) for i, x in own if len(np.intersect1d(x, h)) > 0.35 * len(set(x.tolist())) and stretch_by_brute_force(x, h)}
    assert want and len(got & want) >= 0.9 * len(want) and got <= want


def stretch_by_brute_force(item, region):
    """Longest alignments row by row: an entry per number of edits and region unit."""
    import numpy as np

    n, m = len(item), len(region)
    none, most = -(1 << 20), n // leaks.PER_CHANGE
    needed = np.maximum(-(-n // leaks.LEAST_SHARE), leaks.PER_CHANGE * np.arange(most + 1))[:, None]
    rows = np.full((most + 1, m + 1), none)
    rows[0] = 0
    for unit in item:
        now = np.full((most + 1, m + 1), none)
        now[:, 1:] = np.where(region == unit, rows[:, :-1] + 1, none)
        now[1:, 1:] = np.maximum(now[1:, 1:], rows[:-1, :-1] + 1)
        now[1:] = np.maximum(now[1:], rows[:-1] + 1)
        now[0] = np.maximum(now[0], 0)
        for e in range(1, most + 1):
            np.maximum(now[e, 1:], now[e - 1, :-1], out=now[e, 1:])
        if (now >= needed).any():
            return True
        rows = now
    return False


def test_stretch_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(3)
    seen = Counter()
    for _ in range(400):
        n = int(rng.integers(1, 45))
        item = rng.integers(1, 60, n).astype(np.uint64)
        copy = item[(a := int(rng.integers(0, n // 2 + 1))) :][: int(rng.integers(n // 2, n + 1))].tolist()
        for _ in range(int(rng.integers(0, max(1, len(copy) // 7 + 2)))):
            at = int(rng.integers(0, len(copy) + 1))
            copy[at : at + int(rng.integers(0, 2))] = [99] * int(rng.integers(0, 2))
        before = rng.integers(60, 90, int(rng.integers(0, 9))).tolist()
        region = np.array([*before, *copy, *rng.integers(60, 90, int(rng.integers(0, 9))).tolist()], np.uint64)
        want = stretch_by_brute_force(item, region)
        assert leaks.contains_stretch(item, region, len(before) - a, n) == want
        seen[want] += 1
    assert min(seen.values()) > 40


@pytest.mark.parametrize("edited", [False, True])
def test_leak_recall_by_length(edited):
    """Whole items and halves of them at every place of a document, with one unit in ten changed for items that allow it."""
    import numpy as np

    rng = np.random.default_rng(9)
    for n in (1, 2, 3, 4, 5, 6, 8, 9, 12, 16, 24, 40, 80, 160):
        items = [[f"i{k}u{j}" for j in range(n)] for k in range(24)]
        index = leaks._index([(k, " ".join(x)) for k, x in enumerate(items)])
        docs = []
        for k, x in enumerate(items):
            half = -(-n // 2)
            part = x if k % 2 else x[(a := int(rng.integers(0, n - half + 1))) : a + half]
            if edited:
                # evenly, so that the stretch keeps one change in ten units at most
                part = [w if j % 10 != 9 else "changed" for j, w in enumerate(part)][: len(part) // 10 * 10 or None]
                part = part if len(part) >= half else x[:half]
            docs.append([f"n{j}" for j in range(k % 7)] + part + ["end"])
        hashes = leaks.WordHashes()
        found = {(d, index[0].items[i][0]) for d, i in leaks.scan(index[0], [hashes(d) for d in docs])}
        hit = sum((k, k) in found for k in range(len(items)))
        assert len(index) == 1 and hit >= (0.9 * len(items) if edited else len(items)), (n, hit)


def test_long_tags():
    link = '<a href="' + "x" * 5000 + '">'
    assert leaks.units(f"one {link}two</a> three", False) == ["one", "two", "three"]


# 10 --------------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def model():
    return sentences.train(pd.read_parquet(D + "documents.parquet").text.dropna().tolist())


@pytest.mark.parametrize(
    "units",
    [
        ["Dr. Smith of Acme Inc. told the team that it failed.", "The score rose from 2.6 to 7.3, i.e. a lot!", "Who knows?"],
        ["The relay belongs to Acme Ltd.", "On older kernels, it stops ... then it runs."],
        ["It was signed by E. L. Jones at 8:54 p.m. on Jan. 25.", "Next."],
        ["“Is it safe?” asked the reviewer, and nobody knew.", "“A runs. B runs!” was the only comment.", "“It runs.”", "(Compare No. 32, where it ran.)", "Done."],
        ["Laut Dr. Kern gilt Nr. 84 bzw. Abs. 4 nur hier.", "Er kam am 11. März gegen 9.40 Uhr.", "„Ist das sicher?“, fragte er."],
        ["« Qui a signé ? » demande Anne sans attendre.", "Selon M. Petit, la note atteint 7,5 sur 10.", "La file bloque."],
        ["В 2093 г. узел отключили.", "Модуль хранит ключи, т. е. по ночам."],
        ["الخدمة تحذف السجلات.", "ذكر د. سامي أن القيمة 9.6 فقط."],
    ],
)
def test_sentences(model, units):
    text = " ".join(units)
    assert [text[a:b] for a, b in sentences.sentence_spans(text, model)] == units


def test_sentence_layout(model):
    text = "## Summary\r\n\r\nIt runs\r\nwell.It stops.  Then nothing\n\n- one\n- Two runs. It ends.\n2) no number\n\n> quoted text\n"
    got = [text[a:b] for a, b in sentences.sentence_spans(text, model)]
    assert got == ["## Summary", "It runs\r\nwell.", "It stops.", "Then nothing", "- one", "- Two runs.", "It ends.", "2) no number", "> quoted text"]
    zh = "“安全吗？”Anna问道，但没有人回答。他写道：“服务停了。”版本1.5的评分是4.0，会话代理重启了！"
    assert [zh[a:b] for a, b in sentences.sentence_spans(zh, model)] == ["“安全吗？”Anna问道，但没有人回答。", "他写道：“服务停了。”", "版本1.5的评分是4.0，会话代理重启了！"]
    thai = "โหนดภายในลบบันทึก เกตเวย์ยอมรับโทเคน"
    assert [thai[a:b] for a, b in sentences.sentence_spans(thai, model)] == thai.split(" ")
    assert sentences.sentence_spans(" \n", model) == sentences.sentence_spans(None, model) == []


def test_sentences_of_tables(spark):
    df = spark.createDataFrame([(1, "One. Two."), (1, "One. Two."), (None, "A"), (2, None), (3, ""), (4, "x " * 50000)], "doc_id long, text string").withColumn("start_at", F.lit("clash"))
    rows = sentences.split_sentences(df, "doc_id", "text", sentences.fit(df, "doc_id", "text")).collect()
    assert sorted((r.doc_id or 0, r.start_at, r.end_at) for r in rows) == [(0, 0, 1), (1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9), (4, 0, 99999)]
    assert sentences.split_sentences(df.limit(0), "doc_id", "text", sentences.fit(df.limit(0), "doc_id", "text")).count() == 0


def test_learned_abbreviations(spark):
    """A word that no list has, from how it is used over all documents; brute force counts the same."""
    texts = [f"The unit xq. {n} runs with grmb. parts of Grmb. Nothing else.\n\nIt ends." for n in range(60)] + [None, "", "One grmb. more."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("word", F.lit("clash"))
    known = sentences.learn_abbreviations(df, "text")
    assert known.kinds == {"xq": "leading", "grmb": "leading"}
    text = "It is in xq. Berlin now. Next."
    plain, taught = sentences.train([]), sentences.train([], known=known)
    assert len(sentences.sentence_spans(text, plain)) == 3 and [text[a:b] for a, b in sentences.sentence_spans(text, taught)] == ["It is in xq. Berlin now.", "Next."]
    assert sentences.learn_abbreviations(df.limit(0), "text").kinds == {}


def test_thai_through_the_model(model):
    text = "โหนดภายในลบบันทึก 25 รายการ เกตเวย์ยอมรับโทเคน"
    assert [text[a:b] for a, b in sentences.sentence_spans(text, model)] == ["โหนดภายในลบบันทึก 25", "รายการ", "เกตเวย์ยอมรับโทเคน"]
    never = sentences.Model({"bias": -5.0})
    assert len(sentences.sentence_spans(text, never)) == 1
