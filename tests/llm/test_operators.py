"""Each operator against a brute-force version, and on odd rows."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import compare
from samples import frame, prose
from layerwell.llm import (
    decontamination, html_extraction, importance, labelled_pages, language_id, near_dedup, packing,
    quality_rules, sharding, substring_dedup, token_counts,
)
from layerwell.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert compare.spark_rows(QUERIES[name](spark, SF)) == compare.sql_rows(compare.connect(SF), ORACLE[name])


# token counts

def test_edits_match_a_full_count():
    count, r = token_counts.counter(token_counts.VOCABULARY), random.Random(3)
    letters = "ab  \n's'llé1 2.,!  xx"
    text = lambda n: "".join(r.choice(letters) for _ in range(n))
    for _ in range(300):
        old = text(r.choice([0, 1, 40, 500]))
        edits = [(a := r.randint(0, len(old)), min(len(old), a + r.choice([0, 1, 20])), text(r.choice([0, 1, 6])))
                 for _ in range(r.choice([0, 1, 4]))]
        chars, tokens = count.build(old)
        new, new_chars, new_tokens, total, _ = token_counts.apply_edits(old, chars, tokens, edits, count)
        want = old
        for a, b, x in reversed(token_counts.merged_edits(edits, len(old))):
            want = want[:a] + x + want[b:]
        whole = len(count.tokenizer.encode(want, add_special_tokens=False).ids)
        assert (new, sum(new_chars), total, sum(new_tokens)) == (want, len(want), whole, whole)


def test_one_edit_encodes_a_small_part():
    count, text = token_counts.counter(token_counts.VOCABULARY), prose(1, 5000)
    *_, encoded = token_counts.apply_edits(text, *count.build(text), [(20_000, 20_003, "new")], count)
    assert 0 < encoded < 300


def test_token_counts_of_odd_rows(odd, empty, odd_rows):
    count = token_counts.counter(token_counts.VOCABULARY)
    rows = token_counts.count_after_clean_up(odd).collect()
    want = Counter((i, sum(count.build(t or "")[1])) for i, t, _ in odd_rows)
    assert Counter((r.doc_id, r.tokens_before) for r in rows) == want
    assert token_counts.count_after_clean_up(empty).count() == 0


# sharding

def test_shards_hold_the_mixture(odd, empty, odd_rows):
    rows = sharding.shard_documents(odd, shards=4).collect()
    assert len(rows) == len(odd_rows) and {r.law for r in rows} == {"rows"}
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    for source, n in Counter(s for _, _, s in odd_rows).items():
        for own in by_shard.values():
            assert abs(sum(r.source == source for r in own) - n / 4) <= 2
    sums = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == sums
    assert sharding.shard_documents(empty).count() == 0


def test_rows_without_ids_spread_over_the_ranges(spark, monkeypatch):
    seen = []
    total = sharding.running_total
    monkeypatch.setattr(sharding, "running_total", lambda df, *a, **k: seen.append(df) or total(df, *a, **k))
    docs = spark.range(9000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat('text ', id) as text", "'s' as source")
    assert sharding.shard_documents(docs).count() == 9000
    assert seen[0].groupBy("range").count().agg({"count": "max"}).first()[0] < 20



# substring dedup

def _exact_repeats(rows, length):
    seen, need = set(), defaultdict(set)
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (text or "").lower().encode().split()
        for p in range(len(words) - length + 1):
            gram = tuple(words[p : p + length])
            need[i].update(range(p, p + length) if gram in seen else ())
            seen.add(gram)
    return need


def test_repeated_passages_are_found(odd, empty, odd_rows):
    found = substring_dedup.find_repeats(odd).collect()
    have = defaultdict(set)
    for r in found:
        assert r.end_word - r.start_word >= 50
        have[r.doc_id].update(range(r.start_word, r.end_word))
    need = _exact_repeats([r for r in odd_rows if r[0] != 34], 55)
    assert all(len(need[i] - have[i]) <= 5 for i in need)
    have = {i: words for i, words in have.items() if words}
    assert not have.keys() & set(range(20)) and {51, 61, 62} <= have.keys()
    assert substring_dedup.find_repeats(empty).count() == 0


def test_fuzzy_passage(spark):
    words = prose(20, 80).split()
    other = [w if i % 17 else "changed" for i, w in enumerate(words)]
    rows = [(1, prose(21) + " " + " ".join(words), "a"), (2, " ".join(other) + " " + prose(22), "a")]
    (r,) = substring_dedup.find_repeats(frame(spark, rows)).collect()
    assert (r.doc_id, r.source_doc_id) == (2, 1) and r.end_word - r.start_word >= 70


def test_chains_follow_the_best_order():
    matches = np.array([(i, i + 100) for i in range(0, 40, 8)] + [(20, 5), (3, 300)])
    chain = substring_dedup.chains(matches)[0]
    assert chain.tolist() == [[i, i + 100] for i in range(0, 40, 8)]


def test_common_words():
    r = random.Random(1)
    for _ in range(100):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert substring_dedup.common_words(a, b) == table[-1][-1]


def test_cut_repeats(odd):
    left = {(r.doc_id, r.text) for r in substring_dedup.cut_repeats(odd).select("doc_id", "text").collect()}
    ids = Counter(i for i, _ in left)
    assert {30, 31, 32, 33} <= set(ids) and 61 not in ids
    (text,) = [t for i, t in left if i == 51]
    assert text.startswith(prose(10)) and len(text.split()) < 100


# quality rules

def test_quality_rules_of_odd_rows(odd, empty, odd_rows):
    rows = quality_rules.judge_documents(odd).collect()
    assert len(rows) == len(odd_rows)
    for i, text, _ in odd_rows:
        words = (text or "").encode().split()
        grams = Counter(zip(words, words[1:], words[2:]))
        hit = {p + k for p, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        assert any((r.doc_id, r.n_words, r.n_repeat_words) == (i, len(words), len(hit)) for r in rows)
    kept = quality_rules.clean_documents(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= set(range(20))
    assert quality_rules.judge_documents(empty).count() == 0


def test_failing_lines_are_removed():
    text = prose(1) + "\nHome | News | About | Contact\nLicensed under the Apache License.\n" + prose(2)
    row, left = quality_rules.clean(text)
    assert row["kept"] and row["n_lines_removed"] == 2 and left == prose(1) + "\n" + prose(2)
    assert not quality_rules.clean("\n".join(f"Home{i} | News{i} | About{i}" for i in range(40)))[0]["kept"]


@pytest.mark.parametrize("mark", ["。", "।", "؟", "։", "።", "។", "။", "!"])
def test_sentences_end_in_any_script(mark):
    words = [f"w{i}" for i in range(12)]
    assert quality_rules.line_verdict(" ".join(words) + mark, [*words[:-1], words[-1] + mark], 40, False) is None
    assert quality_rules.line_verdict(" ".join(words), words, 40, False) == "punctuation"


# packing

def _round_robin(lengths, window, grain):
    """Grains in the order a deficit round-robin sends them."""
    total = sum(sum(v) for v in lengths.values())
    deficit, queue, sent = dict.fromkeys(lengths, 0.0), {}, []
    for s, docs in lengths.items():
        queue[s] = [(d, p, min(grain, n - p)) for d, n in enumerate(docs) for p in range(0, n, grain)]
    while any(queue.values()):
        for s in sorted(queue):
            deficit[s] += sum(lengths[s]) * window / total
            while queue[s] and queue[s][0][2] <= deficit[s] + 1e-6:
                deficit[s] -= queue[s][0][2]
                sent.append((s, *queue[s].pop(0)))
    return sent


def test_packing_is_a_deficit_round_robin(spark):
    r = random.Random(2)
    lengths = {f"={s}": [r.choice([1, 30, 700, 3000]) for _ in range(n)] for s, n in (("a", 9), ("b", 4), ("c", 1))}
    rows, names = [], {}
    for s, docs in lengths.items():
        ids = [len(rows) + k for k in range(len(docs))]
        h = {i: xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) for i in ids}
        signed = {i: x - 2**64 if x >= 2**63 else x for i, x in h.items()}
        for n, i in zip(docs, sorted(ids, key=lambda i: (signed[i] % 4096, signed[i]))):
            names[s, len([1 for k in names if k[0] == s])] = i
            rows.append((i, i, s[1:], 0, n))
    counts = spark.createDataFrame(rows, "key long, doc_id long, source string, th long, n long")
    plan = packing.plan_pieces(counts, window=512, grain=128)
    got = [(p.key, p.start + k) for p in sorted(plan.collect(), key=lambda p: (p.sequence_id, p.offset)) for k in range(p.length)]
    want = [(names[s, d], p + k) for s, d, p, n in _round_robin(lengths, 512, 128) for k in range(n)]
    assert got == want


def test_packing_spreads_rows_without_an_id(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.xxhash64(F.col("id").cast("string")).alias("th")
    )
    place = F.pmod(packing.shuffled_order(), F.lit(64))
    sizes = [r["count"] for r in rows.groupBy(place).count().collect()]
    assert max(sizes) < 1.5 * 30_000 / 64


def test_packing_round_trip(odd, empty, odd_rows):
    rows = packing.pack_documents(odd, window=512).collect()
    own = packing.encoder(packing.VOCABULARY)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for s, pieces in by_sequence.items():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) == 512 or s == max(by_sequence)
    want = Counter()
    for i, text, _ in odd_rows:
        want[i] += len(own.whole(text or "")) // 2 + 1
    assert sum((Counter({r.doc_id: r.length}) for r in rows), Counter()) == want
    for i, text in ((0, odd_rows[0][1]), (40, prose(8, 20_000))):
        ids = np.frombuffer(own.whole(text) + b"\2\0", "<u2").astype("<u4")
        for r in rows:
            if r.doc_id == i:
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert packing.pack_documents(empty).count() == 0


def test_encoder_matches_the_tokenizer():
    own, r = packing.encoder(packing.VOCABULARY), random.Random(4)
    texts = ["".join(r.choice("aÉß_'sltm12-!… –\t\nxŉžĲ÷¿µ日İ²") for _ in range(12)) for _ in range(500)]
    assert own.encode([*texts, None, "", "<|endoftext|>"]) == [own.whole(t) for t in (*texts, "", "", "<|endoftext|>")]


# decontamination

def test_leaks_in_any_order(spark, odd, empty):
    items = [(1, "alpha beta gamma delta epsilon zeta. eta theta iota kappa lambda mu. nu xi omicron pi rho sigma."),
             (2, "too short"), (None, None), (3, prose(11, 40))]
    benchmark = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, key string")
    parts = items[0][1].split(". ")
    docs = frame(spark, [(1, prose(1) + " " + ". ".join(reversed(parts)), "a"), (2, prose(2), "a"), (3, None, "a"),
                         (4, prose(3) + " " + parts[0], "a"), (5, items[0][1].upper(), "a")])
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 1), (5, 1)} and got[1, 1].n_tiles >= 3 and got[5, 1].n_tiles == 1
    assert {r.doc_id for r in decontamination.drop_leaks(docs, benchmark).collect()} == {2, 3, 4}
    assert {r.doc_id for r in decontamination.find_leaks(odd, benchmark).collect()} == {60, 61, 62}
    assert decontamination.find_leaks(empty, benchmark).count() == 0
    assert decontamination.drop_leaks(odd, benchmark.limit(0)).count() == odd.count()


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = compare.spark_rows(decontamination.find_leaks(docs, benchmark))
    cut = decontamination.blocks
    monkeypatch.setattr(decontamination, "blocks", lambda b: cut(b, 1500))
    assert compare.spark_rows(decontamination.find_leaks(docs, benchmark)) == whole
    assert decontamination.drop_leaks(docs, benchmark).count() == docs.count() - len({r[1] for r in whole[1]})


def test_tiles_by_brute_force():
    r = random.Random(6)
    for _ in range(60):
        item, text = (np.array([r.randint(0, 3) for _ in range(r.randint(3, 30))]) for _ in range(2))
        used, other, want = [False] * len(item), [False] * len(text), []
        while True:
            best = (0, 0, 0)
            for p in range(len(item)):
                for t in range(len(text)):
                    n = 0
                    while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and not used[p + n] and not other[t + n]:
                        n += 1
                    if n > best[0]:
                        best = (n, p, t)
            if best[0] < 3:
                break
            n, p, t = best
            used[p : p + n], other[t : t + n] = [True] * n, [True] * n
            want.append(n)
        got = [n for _, _, n in decontamination.tile(item, text, 3)]
        assert got[:1] == want[:1] and min(got, default=3) >= 3 and abs(sum(got) - sum(want)) <= 6


# language identification

def test_languages_of_held_out_documents(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = language_id.fit(docs)
    rows = language_id.identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    odd_ones = {r.doc_id: r for r in language_id.identify(odd, network).collect()}
    assert {i for i, r in odd_ones.items() if r.lang_pred == "und"} == {30, 31, 32}
    assert language_id.identify(empty).count() == 0


def test_texts_without_a_letter_and_repeated_ids(spark):
    network = language_id.Network.start(["en"], np.random.default_rng(1))
    assert {network.predict(t)[0] for t in ("²", "½ ①", "Ⅷ 12_3", "")} == {"und"}
    assert network.predict("中")[0] == network.predict("é")[0] == "en"
    # One id and text for most rows, and rows without a letter before all others.
    rows = [(1, "the same old text", "en")] * 3000 + [(i, "12 34", "fr") for i in range(3000)]
    rows += [(i, f"mots {i}", "fr") for i in range(3000, 3100)]
    network = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 20)
    assert network.languages == ["en", "fr"]


def test_training_documents_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda x, y, languages: seen.append((x, y, languages)))
    rows = [(i, f"text {i}", "en" if i % 10 else "fr") for i in range(30_000)]
    language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 50)
    (x, y, languages), = seen
    assert languages == ["en", "fr"] and np.bincount(y).tolist() == [50, 50] and len(np.unique(x, axis=0)) == 100


# importance resampling

def test_resampling(spark, odd, empty, odd_rows):
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(10)] + [(41, 0, 0, "x"), (None, 1, 0, "x")], "doc_id long, quality int, toxic int, n string")
    ratios = importance.log_ratios(odd, labels)
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for i, text, _ in odd_rows:
        own = np.bincount(importance.features(text), minlength=importance.BUCKETS)
        raw += own
        target += own * (i is not None and i < 10)
    want = np.log((target + 1) / (target.sum() + importance.BUCKETS)) - np.log((raw + 1) / (raw.sum() + importance.BUCKETS))
    assert np.allclose(ratios, want)
    rows = importance.resample(odd, labels, share=0.5).collect()
    chosen = [r.sample_key for r in rows if r.selected]
    assert len(rows) == len(odd_rows) and len(chosen) == len(odd_rows) // 2
    assert min(chosen) >= max(r.sample_key for r in rows if not r.selected)
    assert importance.resample(empty, labels).count() == 0
    assert {r.log_weight for r in importance.resample(odd, labels.limit(0)).collect()} == {0.0}


# near-duplicates

def _components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_every_pair_within_the_radius_meets():
    r = random.Random(1)
    for _ in range(2000):
        flips = sum(1 << p for p in r.sample(range(64), r.randint(0, 3)))
        assert any(not flips & mask for mask in near_dedup.MASKS)
    for mask, inner in zip(near_dedup.MASKS, near_dedup.INNER):
        free = [p for p in range(64) if not mask >> p & 1]
        flips = sum(1 << p for p in r.sample(free, 3))
        assert any(not flips & m for m in inner)


@pytest.mark.parametrize("bucket_rows", [2000, 2])
def test_components(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(near_dedup, "BUCKET_ROWS", bucket_rows)
    r, prints = random.Random(2), []
    for _ in range(12):
        value = r.getrandbits(64)
        for _ in range(12):
            value ^= sum(1 << p for p in r.sample(range(64), r.randint(0, 5)))
            prints.append(value)
    rows = [(i, i, 0, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)]
    frame_ = spark.createDataFrame(rows, "doc_id long, did long, th long, fp long")
    got = {x.doc_id: x.component_id for x in near_dedup._with_component(frame_).collect()}
    groups = defaultdict(list)
    for i, g in enumerate(_components(prints)):
        groups[g].append(i)
    assert got == {i: min(g) for g in groups.values() for i in g}


def test_near_duplicates_of_odd_rows(odd, empty, odd_rows):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[i].fingerprint for i in (30, 31, 32)} == {"0" * 16} and by_id[32].component_id == 30
    assert by_id[61].component_id == 60
    one = xxhash.xxh64_intdigest(b"one", 42)
    assert by_id[33].fingerprint == f"{one:016x}"
    kept = near_dedup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.component_id if r.doc_id is not None else None for r in rows if r.doc_id != 34}) + 2
    assert near_dedup.near_duplicates(empty).count() == 0 == near_dedup.keep_one_of_each(empty).count()


# HTML extraction

@pytest.fixture(scope="session")
def model():
    return html_extraction.train()


def test_generated_pages_not_learned_from(model):
    wrong = total = 0
    for page, content in labelled_pages.labelled_pages(120, 77):
        nodes = html_extraction.parse(page)
        for node, share in zip(nodes, model.marginals(nodes)):
            if node.group == "run":
                total += 1
                wrong += (share >= 0.5) != (node.text in content)
    assert wrong < 0.02 * total


def test_marginals_by_enumeration(model):
    page = '<div class="content"><p>Some longer text that ends.</p><p>x</p></div><nav>a</nav>'
    nodes = html_extraction.parse(page)
    own, n = html_extraction.features(nodes), len(nodes)
    weights = np.zeros((2**n, n), bool)
    logs = np.zeros(2**n)
    for s in range(2**n):
        bits = [s >> i & 1 for i in range(n)]
        weights[s] = bits
        logs[s] = sum(b * sum(model.unary.get(f, 0.0) for f in fs) for b, fs in zip(bits, own))
        for i in range(1, n):
            logs[s] += model.pair.get(html_extraction.edge(nodes, i), (0,) * 4)[2 * bits[nodes[i].parent] + bits[i]]
    p = np.exp(logs - logs.max())
    assert np.allclose(weights.T @ p / p.sum(), model.marginals(nodes))


def test_extraction(spark, model):
    page = (
        '<html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav>'
        '<div class="cookie-notice"><p>We use cookies.</p></div><article><h1>A title here</h1><p><b>First &amp; foremost,  a'
        "\n sentence.<br><p>Second paragraph, which is longer.</p></article>"
        '<div id="comments"><div class="comment"><p>I liked this a lot.</p></div></div><footer>&copy; someone</footer></body>'
    )
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<div" * 500 + "<p", "x"), (1, "u", page, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extraction.extract_text(pages, model).collect()
    want = "A title here\n\nFirst & foremost, a sentence.\n\nSecond paragraph, which is longer."
    assert [r.text for r in got if r.page_id == 1] == [want] * 2 and len(got) == 5
    assert all(r.n_chars == len(r.text) for r in got) and {r.text for r in got if r.page_id in (2, None)} == {""}
    assert html_extraction.extract_text(pages.limit(0), model).count() == 0


@pytest.mark.parametrize("page, runs", [
    ("<header><svg><path></header><p>one</p>", ["one"]),
    ("<body><svg><title>t</title><article><p>one</p></article>", ["one"]),
    ("<body><object data=x><article><p>one</p></article><svg><text>no</text></svg>", ["one"]),
    ("<div><noscript><p>no</p></noscript>one</div>", ["one"]),
    ("<div><template></div><p>one</p><template>no</template>two", ["one", "two"]),
    ("<p>one<script>if (a > b) no</p>", ["one"]),
    ("<p>one<!-- no > no", ["one"]),
    ("<p>a > b <!-- no", ["a > b"]),
    ('<p title="a > b">one<img alt="x>two<p>three</p>', ["onetwo", "three"]),
])
def test_unclosed_elements(page, runs):
    got = [n.text for n in html_extraction.parse(page) if n.group == "run" and n.text]
    assert got == runs


@pytest.mark.parametrize("piece", [
    "<a ", '<a ">"', "<svg>", "</div>", "<!-", "<a '>\"'>", "<script>", "<div><object></div>", "<p><svg>x</p>", '<a "\'>', "&",
])
def test_long_broken_pages_take_linear_time(piece):
    start = time.process_time()
    html_extraction.parse(piece * (400_000 // len(piece)))
    assert time.process_time() - start < 5


def test_labelled_pages_are_chosen_by_hash(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_extraction, "fit", lambda cases: seen.append(len(cases)))
    page = "<article><p>Text of page {}.</p></article>"
    rows = [(i, page.format(i)) for i in range(2000)] + [(1, page.format(1))] * 1000
    html_extraction.train(spark.createDataFrame(rows, "page_id long, html string"))
    assert seen == [html_extraction.LABELLED_PAGES + html_extraction.TABLE_PAGES]
