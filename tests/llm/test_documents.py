"""The operators on documents against brute force, with nulls, ties, long texts and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from scoreloom.llm import bpe, decontaminate, quality, sharding, simhash, suffixes, token_files
from scoreloom.llm.common import RELEASE_SETTING
from scoreloom.llm.queries import tokenizer
from scoreloom.plans.durable import fresh_path

SCHEMA = "doc_id long, text string, words string, shard string, kept int, n_words int, items int"
WORDS = "the of and that is on ére straße naïve café über data model score".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "."]) for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    base = [prose(rng, rng.randint(0, 150)) for _ in range(40)]
    passage = prose(rng, 30)
    rows: list = []
    for i in range(120):
        text = rng.choice(base) if rng.random() < 0.4 else prose(rng, rng.randint(0, 120))
        if rng.random() < 0.3:
            at = rng.randint(0, len(text))
            text = text[:at] + passage + text[at:]
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a" * 5000), (204, "ab " * 4000)]
    rows += [(5, rows[5][1]), (5, "another text of the same id " * 4), (None, base[0]), (None, base[0])]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def documents(spark, rows):
    data = [(i, t, "w", "s", 1, 2, 3) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(4).cache()


def by_key(rows):
    return sorted(rows, key=repr)


# --- sharding ---------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 3, 41])
def test_permutation_is_one_and_has_an_inverse(spark, size):
    permutation = sharding.Permutation(size, seed=3)
    there, back = permutation.longest_walk(spark), permutation.longest_walk(spark, forward=False)
    numbers = spark.range(size)
    images = numbers.select("id", permutation.image(numbers["id"], there).alias("p"))
    pairs = images.select("id", "p", permutation.image(images["p"], back, False).alias("q")).collect()
    assert sorted(r["p"] for r in pairs) == list(range(size))
    assert all(r["id"] == r["q"] for r in pairs)


def test_shards_have_equal_rows_and_gapless_slots(spark, documents, rows):
    keys = sharding.document_keys(documents)
    order = ["doc_id", "text_crc32", "size"]
    placed = sharding.shard_rows(keys, order, 7, seed=5).collect()
    assert by_key((r["doc_id"], r["size"], r["text_crc32"]) for r in placed) == by_key(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_rows(keys.repartition(3), order, 7, seed=5).collect()
    assert by_key(map(tuple, again)) == by_key(map(tuple, placed))
    places = spark.createDataFrame([(r["shard"], r["slot"]) for r in placed], "shard int, slot long")
    found = sharding.rows_at(places, len(rows), 7, seed=5).collect()
    want = {(r["shard"], r["slot"]): r["row_number"] for r in placed}
    assert all(want[r["shard"], r["slot"]] == r["row_number"] for r in found)


def test_sharding_an_empty_table(spark, documents):
    keys = sharding.document_keys(documents.limit(0))
    assert sharding.shard_rows(keys, ["doc_id"], 4).count() == 0


# --- decontamination --------------------------------------------------------------------------


def hits_by_brute_force(text: str | None, items, window: int):
    def words(t):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    own, hit, found = words(text), set(), set()
    for item, given in items:
        ws = words(given)
        k = min(window, len(ws))
        for j in range(len(ws) - k + 1 if k else 0):
            for i in range(len(own) - k + 1):
                if own[i : i + k] == ws[j : j + k]:
                    hit.update(range(i, i + k))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 25])
def test_contamination_against_brute_force(spark, documents, rows, block):
    rng = random.Random(2)
    long_ = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(i, " ".join(rng.choice(long_).split()[3:25]).upper()) for i in range(4)]
    items += [(4, items[0][1]), (5, "the of"), (6, None), (7, ""), (None, "Über, data!"), (8, "!!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(documents, benchmark, 10, block).collect()
    want = [(i, *hits_by_brute_force(t, items, 10)) for i, t in rows]
    assert by_key((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == by_key(want)
    clean = decontaminate.drop_contaminated(documents, benchmark)
    assert clean.columns == documents.columns
    assert by_key(r["doc_id"] for r in clean.collect()) == by_key(w[0] for w in want if not w[2])
    found = decontaminate.find_contamination(documents, benchmark)
    cut = decontaminate.find_contamination(decontaminate.remove_spans(found), benchmark)
    before, after = (f.agg({"n_hit": "sum"}).first()[0] for f in (found, cut))
    assert after < before / 4


def test_contamination_of_and_by_nothing(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(documents, none).filter("n_hit > 0").isEmpty()
    assert decontaminate.find_contamination(documents.limit(0), none).isEmpty()


# --- suffix arrays ----------------------------------------------------------------------------


def removed_by_brute_force(rows, span: int):
    least: dict = {}
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - span + 1):
            piece = data[k : k + span]
            least[piece] = min(least.get(piece, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - span + 1):
            if least[data[k : k + span]] < ((1 << 63) - 1 if i is None else i):
                gone[k : k + span] = b"\1" * span
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return out


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 300, "group_bytes": 400}])
def test_repeats_against_brute_force(documents, rows, limits):
    got = suffixes.remove_repeats(documents, **limits).collect()
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans")
    found = by_key((*(r[c] for c in columns), bytes(r["kept"])) for r in got)
    assert found == by_key(removed_by_brute_force(rows, 50))


def test_slices_are_cut_in_one_pass(spark, monkeypatch):
    """Scans after the first cut their slices elsewhere, as after the loss of an executor."""
    rng = random.Random(4)
    passage = " ".join(str(rng.getrandbits(40)) for _ in range(30))
    rows = [(i, f"{rng.getrandbits(80)} {passage} {rng.getrandbits(80)}") for i in range(2)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).cache()
    given, scans = suffixes._marks, []

    def marks(*arguments):
        scans.append(arguments)
        run, alone = given(*arguments), len(scans) > 1

        def cut(batches):
            if not alone:
                yield from run(batches)
                return
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from run(iter([batch.slice(i, 1)]))

        return cut

    monkeypatch.setattr(suffixes, "_marks", marks)
    got = suffixes.remove_repeats(documents).collect()
    found = by_key((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got)
    assert found == by_key(removed_by_brute_force(rows, 50))


def test_texts_of_one_key_are_no_single_row(spark, monkeypatch):
    rng = random.Random(8)
    first = [" ".join(str(rng.getrandbits(40)) for _ in range(20)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(first)]
    rows += [(None, t + str(rng.getrandbits(60))) for t in first] + [(None, first[0])] * 30
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    given, most = suffixes._cut, spark.sparkContext.accumulator(0)

    def counting(*arguments):
        run = given(*arguments)

        def cut(batches):
            def counted():
                for batch in batches:
                    lists = batch.column(batch.schema.get_field_index("_spans"))
                    most.add(sum(n or 0 for n in lists.value_lengths().to_pylist()))
                    yield batch

            return run(counted())

        return cut

    monkeypatch.setattr(suffixes, "_cut", counting)
    got = suffixes.remove_repeats(documents).collect()
    found = by_key((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got)
    assert found == by_key(removed_by_brute_force(rows, 50))
    assert most.value < 40 * len(rows)


def test_windows_of_large_groups_come_in_batches():
    import pyarrow as pa

    snippet = b"ab" * 100_000
    names = ["hash", "snippet", "doc", "twin", "start", "more", "size"]
    kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.int64()]
    values = [[5, 5], [snippet, snippet[:99]], [1, 2], [0, 0], [3, 0], [None, [7]], [0, 0]]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names
    )
    parts = list(suffixes._hot_windows(50)(iter([rows])))
    assert max(p.num_rows for p in parts) <= 50_000
    got = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    want = [(snippet[i : i + 50], 1, 0, [3 + i]) for i in range(len(snippet) - 49)]
    assert got == want + [(snippet[i : i + 50], 2, 0, [i, 7 + i]) for i in range(50)]


def test_suffix_order_is_that_of_the_suffixes():
    rng = random.Random(1)
    for _ in range(50):
        data = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90))).encode()
        symbols = np.frombuffer(data + b"\0", np.uint8).astype(np.uint16) + 1
        symbols[-1] = 0
        order, _ = suffixes.suffix_array(symbols, np.arange(len(data), -1, -1), 98)
        assert [data[i:] for i in order] == sorted(data[i:] for i in range(len(data) + 1))


def test_texts_without_repeats_keep_their_columns(spark, documents):
    left = suffixes.without_repeats(documents)
    assert left.columns == documents.columns and left.count() == documents.count()
    assert suffixes.without_repeats(documents.limit(0)).isEmpty()


CLASHING = (
    "doc_id long, text string, kept string, n_bytes int, n_removed string, n_spans double, "
    "n_words int, n_hit string, items int, spans string, row int, doc int, twin string, "
    "_doc int, _spans string, `a.b` int"
)


def clashing(spark, texts):
    own = ("k", 1, "r", 0.5, 7, "h", 3, "s", 4, 5, "t", 6, "u", 8)
    return spark.createDataFrame([(i, t, *own) for i, t in enumerate(texts)], CLASHING)


def test_columns_of_the_caller_stay_whatever_their_names(spark):
    rng = random.Random(2)
    passage = " ".join(str(rng.getrandbits(40)) for _ in range(12))
    given = clashing(spark, [f"one {passage}", f"two {passage}", None, "", passage])
    left = suffixes.without_repeats(given)
    assert left.schema.simpleString() == given.schema.simpleString()
    texts = {0: f"one {passage}", 1: "two", 2: None, 3: "", 4: ""}
    want = [(r["doc_id"], texts[r["doc_id"]], *r[2:]) for r in given.collect()]
    got = [(r["doc_id"], r["text"] and r["text"].strip(), *r[2:]) for r in left.collect()]
    assert by_key(got) == by_key(want)

    benchmark = spark.createDataFrame([("b", f"{passage} x")], "item_id string, text string")
    clean = decontaminate.drop_contaminated(given, benchmark)
    assert clean.schema.simpleString() == given.schema.simpleString()
    assert by_key(map(tuple, clean.collect())) == by_key(
        tuple(r) for r in given.collect() if passage not in (r["text"] or "")
    )


def test_shuffles_are_released_and_the_setting_is_restored(spark, documents):
    before = spark.conf.get(RELEASE_SETTING)
    suffixes.remove_repeats(documents)
    assert spark.conf.get(RELEASE_SETTING) == before


# --- SimHash ----------------------------------------------------------------------------------


def fingerprint_by_brute_force(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints: dict, distance: int) -> dict:
    """Smallest key of the component of each fingerprint."""
    left, out = set(prints), {}
    while left:
        todo, group = [left.pop()], set()
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            todo += near
        keys = [k for x in group for k in prints[x] if k is not None]
        for x in group:
            out[x] = min(keys) if keys else None
    return out


def test_near_duplicates_against_brute_force(documents, rows):
    got = simhash.near_duplicates(documents.select("doc_id", "text", "words")).collect()
    prints = defaultdict(list)
    for i, t in rows:
        prints[fingerprint_by_brute_force(t)].append(i)
    of = classes(prints, 4)
    want = [(i, x, of[x]) for x, i in ((fingerprint_by_brute_force(t), i) for i, t in rows)]
    mask = (1 << 64) - 1
    assert by_key(
        (r["doc_id"], r["fingerprint"] & mask, r["component_id"]) for r in got
    ) == by_key(want)
    kept = simhash.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    # One row of each component; the id of a row may stand in several components.
    best: dict = {}
    roots = classes({x: [x] for x in prints}, 4)
    for i, t in rows:
        own, root = (i is None, i or 0, t or ""), roots[fingerprint_by_brute_force(t)]
        best[root] = min(best.get(root, own), own)
    assert by_key(r["doc_id"] for r in kept.collect()) == by_key(
        None if null else i for null, i, _ in best.values()
    )


def test_one_document_of_each_component_stays(spark):
    rng = random.Random(11)
    unlike = [" ".join(f"w{rng.getrandbits(40)}" for _ in range(60)) for _ in range(12)]
    rows = [(None, t) for t in unlike[:6]] + [(7, t) for t in unlike[6:10]]
    rows += [(None, unlike[0]), (7, unlike[6]), (9, unlike[7]), (3, unlike[1]), (8, unlike[10])]
    rows += [(1, None), (None, " "), (None, unlike[11]), (None, unlike[11])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    best: dict = {}
    for i, t in rows:
        group, own = fingerprint_by_brute_force(t), (i is None, i or 0, t or "")
        best[group] = min(best.get(group, own), own)
    assert len(set(classes({x: [x] for x in best}, 4).values())) == len(best) == 13
    want = [(None if null else i, t) for null, i, t in best.values()]
    kept = simhash.drop_near_duplicates(documents).collect()
    assert by_key((r["doc_id"], r["text"] or "") for r in kept) == by_key(want)


@pytest.mark.parametrize(("distance", "limit"), [(4, 1 << 16), (7, 3)])
def test_links_join_what_is_near(spark, distance, limit):
    rng = random.Random(distance)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:20]:
        for _ in range(12):
            values.add(v ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(1, 9))}))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "fingerprint long")
    links = simhash.links(prints, distance, limit)
    found = {s: s for (s,) in signed}
    for finish in (0, 1 << 20):
        rooted = simhash.components(links, finish=finish).collect()
        found = {s: s for (s,) in signed} | {r["node"]: r["root"] for r in rooted}
        want = classes({v: [v - (1 << 64) if v >> 63 else v] for v in values}, distance)
        assert {v & ((1 << 64) - 1): r for v, r in found.items()} == want


# --- quality ----------------------------------------------------------------------------------


def counts_by_brute_force(text: str | None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_rules_against_brute_force(spark, documents, rows):
    extra = [(300, "a|b\n\na|b\n \na <c> a <c> a <c> a"), (301, "x\x0b\x0cy z"), (302, "\n\n")]
    more = spark.createDataFrame([(i, t, "w", "s", 1, 2, 3) for i, t in extra], SCHEMA)
    counted = quality.with_counts(documents.union(more))
    judged = quality.judge(counted, quality.learn_rules(counted)).collect()
    got = by_key((r["doc_id"], *(r[c] for c in quality.COUNTS), r["base_failed"]) for r in judged)
    want = []
    for i, t in [*rows, *extra]:
        c = counts_by_brute_force(t)
        want.append((i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == by_key(want)
    assert not any(r["kept"] and r["base_failed"] for r in judged)


def test_votes_are_weighed():
    names = ("a", "b", "c")
    patterns = [((1, 1, 1), 900), ((-1, 1, 1), 60), ((1, -1, -1), 40), ((1, -1, 1), 1)]
    model = quality.fit_votes(patterns, names)
    assert abs(sum(model.priors) - 1) < 0.01
    for rule in names:
        assert all(a > 0.5 for a in model.accuracy(rule))
    assert quality.fit_votes([], names).priors[0] == pytest.approx(0.95)


def test_keep_good_returns_the_documents_columns(documents):
    counted = quality.with_counts(documents.select("text"))
    kept = quality.keep_good(documents, quality.learn_rules(counted))
    assert kept.columns == documents.columns
    assert all(len(r["text"].split()) >= 50 for r in kept.collect())


# --- tokens -----------------------------------------------------------------------------------

ODD = ["<|endoftext|>", "a<|startoftext|>b", "İΣΑΣ ΟΔΥΣΣΕΥΣ", "x\x1cy\x85z　w", "a  b   c \n d",
       "it's I'LL 12３４ é é", "🙂👍🏽!!", "\ta", "a\n\n\nb", "ﬁ​﻿"]


def odd_rows():
    return [(i, t) for i, t in enumerate(ODD, 400)]


def library(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(name))


def test_words_are_encoded_and_decoded_like_the_library(spark, documents, rows):
    given = [*rows, *odd_rows()]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    got = bpe.encode(frame, tokenizer("word_bpe_49k.json")).collect()
    of = library("word_bpe_49k.json")
    want = []
    for i, t in given:
        ids = of.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, of.decode(ids, skip_special_tokens=False)))
    found = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got]
    assert by_key(found) == by_key(want)
    assert bpe.encode(documents.limit(0), tokenizer("word_bpe_49k.json")).isEmpty()


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files_round_trip(spark, rows, parts):
    given = [*rows, *odd_rows(), *[(7, "the same id again")] * 3]
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    path = fresh_path(spark, "token-test")
    token_files.write_token_files(frame, path, tokenizer("byte_bpe_50k.json"), 2, parts=parts)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    of, at = library("byte_bpe_50k.json"), 0
    for row in got:
        assert row["start"] == at
        at += len(row["ids"]) // 4
    keys = [-1 if r["key"] is None else r["key"] for r in got]
    assert keys == sorted(keys)
    want = [(i, [*of.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in given]
    found = [(r["key"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
    assert by_key(found) == by_key(want)


def test_null_keys_are_spread_over_the_parts(spark):
    given = [(i if i % 3 else None, f"text {i}") for i in range(900)]
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    path = fresh_path(spark, "token-test")
    token_files.write_token_files(frame, path, tokenizer("byte_bpe_50k.json"), 2, parts=9)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    rows_of = defaultdict(int)
    for block in blocks:
        rows_of[block["part"]] += len(block["keys"])
    assert sum(rows_of.values()) == 900 and max(rows_of.values()) < 200
    keys = [r["key"] for r in sorted(
        token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"]
    )]
    assert keys == [None] * 300 + [i for i in range(900) if i % 3]


def test_pieces_are_encoded_like_the_whole_text():
    import pyarrow as pa

    rng = random.Random(3)
    letters = "ab é\n \t\r\u3000\x85\x1c.,'s1\u0663\u65e5<>|\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    texts += ["it's a'b 's x\n'll y", "a\nb c\nd e.", "<|endoftext|>", "w" * 300 + " w" * 300]
    encoder = token_files.PieceEncoder(tokenizer("byte_bpe_50k.json"), kept=50)
    of = library("byte_bpe_50k.json")
    got = encoder.encode(pa.array([*texts, None]))
    assert got.pop() == b""
    for text, ids in zip(texts, got, strict=True):
        want = of.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
    assert len(encoder.pieces) <= 50 and len(encoder.words) <= 50
    assert max(map(len, encoder.pieces)) <= 256


def test_control_and_data_bytes_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(100):
        lists = [
            rng.integers(0, int(rng.choice([9, 300, 70_000, 1 << 32])), int(rng.integers(0, 9)))
            for _ in range(int(rng.integers(1, 6)))
        ]
        packed = [token_files.pack(x.astype("<u4")) for x in lists]
        sizes = np.array([len(x) for x in lists])
        control, data = (b"".join(x) for x in zip(*packed, strict=True))
        assert (token_files.unpack(sizes, control, data) == np.concatenate(lists)).all()


def test_digest_columns():
    ids, text = np.array([1, 70_000], "<u4").tobytes(), "né"
    n, a, b = (x.to_pylist()[0] for x in bpe.digests([ids], [text]))
    assert (n, a, b) == (
        2, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    )
