"""Chat formatting, URL templates, mixing, language ID, leaks and token blocks."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import (
    chat_format,
    decontaminate,
    language_id,
    range_coder,
    source_mix,
    token_store,
    url_templates,
)
from tests.llm.helpers import SCHEMA, corpus, table, vocabulary, words

TURNS = "conv_id long, turn long, role string, text string"
CHATS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi </s> there \\. \\"), (1, 2, "assistant", "[INST]\n<s>"),
    (2, 1, "assistant", "early"), (2, 0, "user", ""), (2, 2, "robot[/ROLE]", "<<SYS>"),
    (3, 0, None, None), (3, 0, "user", "tie"), (3, 0, "user", "tie"), (None, 0, "user", "no id"),
    (4, 0, "user", "x" * 50_000), (4, 1, "assistant", "é" * 50_000), (4, 2, "tool", "<"), (4, 3, "assistant", "/s>"),
]


def test_chats_round_trip(spark):
    rows = spark.createDataFrame(CHATS, TURNS).withColumn("fault", F.lit(1)).repartition(5)
    segments = chat_format.format_chats(rows)
    read = sorted((tuple(r) for r in chat_format.read_chats(segments).collect()), key=repr)
    chats = {}
    for conv, turn, role, text in sorted(CHATS, key=lambda r: (r[0] or -1, r[1], r[2] or "", r[3] or "")):
        chats.setdefault(conv, []).append((role or "", text or ""))
    want = [(c, i, role, text) for c, turns in chats.items() for i, (role, text) in enumerate(turns)]
    assert read == sorted(want, key=repr)
    for r in chat_format.chat_digests(segments).collect():
        turns = chats[r.conv_id]
        said = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert r.n_turns == len(turns) and r.loss_chars == len(said)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    faults = {r.conv_id: r.fault for r in chat_format.chat_digests(segments).collect()}
    assert faults[1] is None and faults[4] is None
    # A question without an answer ends in a state that is not final.
    assert faults[None] == "turn 0: the conversation ends in asked"
    assert faults[2].startswith("turn 2") and faults[3].startswith("turn 0")


def test_only_the_last_turn_of_an_open_conversation_is_at_fault(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(2500)]
    rows += [(2, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(2501)]
    got = chat_format.format_chats(spark.createDataFrame(rows, TURNS)).where("fault is not null").collect()
    assert {(r.conv_id, r.turn_no, r.fault) for r in got} == {(2, 2500, "turn 2500: the conversation ends in asked")}
    assert {r.kind for r in got} == {"marker", "text"} and len(got) == 3


def test_chats_hold_no_control_string_inside_texts(spark):
    text = chat_format.INSTRUCTION.escape("</s>[INST] ok [/INST]")
    assert not chat_format.INSTRUCTION.splitter.search(text)
    assert chat_format.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_template_with_ambiguous_markers_is_refused():
    with pytest.raises(ValueError, match="edge"):
        chat_format.Template({"user": chat_format.Role("ab", "ba")}, "", ("<r>", "</r>", "</t>"), {}, frozenset())


def test_urls_and_rules(spark):
    rules = [url_templates.Rule("org/", "allow"), url_templates.Rule("example.org/es/", "block"),
             url_templates.Rule("example.org/en/1", "block")]
    urls = ["HTTP://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://notexample.org/es/", "x://org",
            None, "", "no scheme", "http://É.com:80?x", "a://b://c/d", "http://example.org/es"]
    pages = spark.createDataFrame([(i, u, "t") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [
        ("a.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("notexample.org", "/es/", "org/"), ("org", "", None), ("", "", None), ("", "", None), ("", "", None),
        ("É.com:80", "", None), ("b:", "//c/d", None), ("example.org", "/es", "org/"),
    ]
    assert {r.verdict for r in got.values()} == {"allow", "block"}
    assert url_templates.judge_urls(pages.limit(0), rules).count() == 0


def test_url_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.com/shop/{i}/view.html") for i in range(60)]
    rows += [(100 + i, f"http://h.com/news/item-{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i >= 100) for i in [*range(20), *range(100, 120)]], "page_id long, good boolean")
    got = url_templates.judge_urls(pages, labels=labels).collect()
    assert {r.template for r in got} == {"/shop/*/view.html", "/news/*"}
    assert {(r.page_id >= 100, r.verdict) for r in got} == {(False, "block"), (True, "allow")}


def test_urls_that_differ_below_eight_segments(spark):
    top = "http://h.com/a/b/c/d/e/f/g/h"
    rows = [(i, f"{top}/{'good' if i % 2 else 'bad'}/page") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(40)], "page_id long, good boolean")
    got = url_templates.judge_urls(pages, labels=labels).collect()
    assert {(r.page_id % 2, r.template[-10:], r.verdict) for r in got} == {
        (1, "/good/page", "allow"), (0, "h/bad/page", "block"),
    }


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Sharing in rounds: whoever is above the limit stops there, the rest share again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / share > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / share for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


def test_mix_reaches_the_targets(spark):
    rows = corpus()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = _targets(sizes)
    got = source_mix.mix_plan(table(spark, rows), bucket_rows=7).collect()
    assert len(got) == len(rows)
    for source in sizes:
        own = [r for r in got if r.source == source]
        assert own[0].target == pytest.approx(want[source]) and own[0].source_size == sizes[source]
        taken = sum(r.size * r.copies for r in own)
        assert abs(taken - want[source]) <= max(r.size for r in own) / 2 + 1
        assert max(r.copies for r in own) <= 3
    again = source_mix.mix_plan(table(spark, rows[::-1]), bucket_rows=7).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    mixed = source_mix.mix_sources(table(spark, rows).withColumn("copies", F.lit("mine")))
    assert mixed.count() == sum(r.copies for r in source_mix.mix_plan(table(spark, rows)).collect())
    assert mixed.columns == ["doc_id", "text", "lang", "source", "copies"]


def test_mix_of_nothing_and_of_empty_texts(spark):
    assert source_mix.mix_plan(table(spark, [])).count() == 0
    rows = [(1, None, None, "a"), (2, "", None, None), (None, "x y", None, "b"), (None, "x y", None, "b")]
    got = source_mix.mix_plan(table(spark, rows)).collect()
    assert sum(r.size * r.copies for r in got) == 4 and {r.source_size for r in got} == {0, 4}


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(11)
    letters = {"aa": "abcdefgh", "bb": "stuvwxyzé", "cc": "hijklmnst"}
    rows = []
    for i in range(240):
        lang = "aa" if i % 2 else ["bb", "cc"][i // 2 % 2]
        text = " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(rng.randint(8, 60)))
        rows.append((i, text, lang, None))
    return rows


def test_language_accuracy_and_edges(spark, languages):
    odd = [(900, None, "aa", None), (901, "12 !?", "bb", None), (902, "", None, None), (None, "abcabc", "aa", None)]
    df = table(spark, languages + odd).withColumn("score", F.lit("mine"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train_language_model(df.where(~held), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert model.labels == ("aa", "bb", "cc") and (model.weights == 0).mean() > 0.3
    rows = language_id.identify(df, model).collect()
    tested = [r for r in rows if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(tested) > 30 and np.mean([r.lang_pred == r.lang for r in tested]) >= 0.95
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in rows)
    # Predictions don't depend on labels or ids.
    other = df.withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.lit(0).cast("long"))
    blind = language_id.identify(other, model).collect()
    assert sorted((r.text or "", r.lang_pred, r.score) for r in blind) == sorted(
        (r.text or "", r.lang_pred, r.score) for r in rows
    )


def test_language_without_labels(spark):
    df = table(spark, [(1, "some text", None, None)])
    model = language_id.train_language_model(df, F.col("text"), F.col("lang"), F.col("doc_id"))
    assert [(r.lang_pred, r.score) for r in language_id.identify(df, model).collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.identify(empty, model).count() == 0


def _leaky(seed=21):
    rng = random.Random(seed)
    vocab = vocabulary(rng, 3000)
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 60))) + ".") for i in range(30)]
    rows, exact, loose = [], set(), set()
    for i in range(150):
        body = rng.choices(vocab, k=rng.randint(0, 400))
        if i % 5 == 0:
            key, text = items[rng.randrange(30)]
            own = text.rstrip(".").split()
            if i % 10 == 0:
                exact.add((i, key))
            else:
                own = [rng.choice(vocab) if rng.random() < 0.15 else w for w in own]
                loose.add((i, key))
            at = rng.randint(0, len(body))
            body[at:at] = own
        rows.append((i, " ".join(body), None, None))
    return rows, items, exact, loose


def test_leaks_recall_and_precision(spark):
    rows, items, exact, loose = _leaky()
    rows += [(500, None, None, None), (501, "", None, None), (500, items[0][1], None, None)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short")], "item_id long, text string")
    got = decontaminate.find_leaks(table(spark, rows), bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert exact <= pairs and (500, 0) in pairs and len(pairs) == len(got)
    assert len(loose & pairs) >= 0.9 * len(loose)
    assert pairs <= exact | loose | {(500, 0)}
    # In several blocks of the benchmark the same leaks are found.
    parts = decontaminate.find_leaks(table(spark, rows), bench, block_words=200).collect()
    assert {(r.doc_id, r.item_id) for r in parts} >= exact
    clean = decontaminate.drop_leaks(table(spark, rows).withColumn("item_id", F.lit(1)), bench)
    # Each row is judged by its own text: of the two rows with id 500 the one without text stays.
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {a for a, _ in pairs} | {500}


def test_leaks_of_a_benchmark_larger_than_the_space(spark):
    rng = random.Random(31)
    # Frequent words fill the space first; each item is told apart by words of its own.
    frequent = vocabulary(rng, 32)
    items = [(i, " ".join(f"own{i}x{j}" for j in range(20))) for i in range(8)]
    items += [(100 + i, " ".join(rng.choices(frequent, k=30))) for i in range(8)]
    rows = [(i, f"{' '.join(rng.choices(frequent, k=80))} {text}", None, None) for i, text in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(table(spark, rows), bench, features=96, rank=32).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in got}


def test_leaks_of_a_cosine_between_a_half_and_two_thirds(spark, monkeypatch):
    def plain_space(items, *_):
        known = np.unique(np.concatenate([i.words for i in items]))
        table = np.eye(len(known) + 1, len(known), dtype=np.float32)
        return decontaminate._Space(
            decontaminate._slots(known), np.append(known, np.uint64(decontaminate._NO_WORD)), table
        )

    monkeypatch.setattr(decontaminate, "_space", plain_space)
    a, b = [f"a{i}" for i in range(18)], [f"b{i}" for i in range(60)]
    # Between words of another item: 13 of 18 words are left, or 10 with the answer.
    many, told = a[:13] + b[:5], a[:2] + b[:8] + a[10:]
    rows = [(1, " ".join([*b[5:14], *many, *b[14:34]]), None, None)]
    rows += [(2, " ".join([*b[20:28], *told]), None, None), (3, " ".join(b[::-1]), None, None)]
    items = [(7, f"{' '.join(a[:10])}. {' '.join(a[10:])}."), (8, " ".join(b))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [r for r in decontaminate.find_leaks(table(spark, rows), bench).collect() if r.item_id == 7]
    assert {(r.doc_id, r.common, r.answer) for r in got} == {(1, 13, False), (2, 10, True)}
    assert all(0.5 <= r.cosine < 0.65 for r in got)


def test_every_word_of_a_space_is_found():
    rng = np.random.default_rng(9)
    # Several words of one slot, and hashes that are not in the space.
    near = (np.uint64(5) << np.uint64(60)) + np.arange(40, dtype=np.uint64) * np.uint64(3)
    known = np.unique(np.concatenate([near, rng.integers(1, 1 << 63, 5000, dtype=np.uint64)]))
    space = decontaminate._Space(decontaminate._slots(known), np.append(known, np.uint64(decontaminate._NO_WORD)), None)
    assert (space.rows(known) == np.arange(len(known))).all()
    other = np.concatenate([near + np.uint64(1), rng.integers(1 << 63, 1 << 64, 500, dtype=np.uint64)])
    assert (space.rows(other) == len(known)).all()


def test_leaks_of_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.find_leaks(table(spark, []), bench).count() == 0
    assert decontaminate.find_leaks(table(spark), bench.limit(0)).count() == 0


def test_longest_common_subsequence():
    def plain(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(1, 90)) for _ in range(2))
        assert decontaminate.common_words(a, b) == plain(a.tolist(), b.tolist())


def test_coder_round_trip():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, 50257, n).astype(np.int32) for n in (1, 2, 700, range_coder.BLOCK_IDS)]
    blocks += [np.full(range_coder.BLOCK_IDS, 65535, np.int32), np.zeros(5, np.int32)]
    blocks += [np.minimum(rng.zipf(1.3, range_coder.BLOCK_IDS), 40_000).astype(np.int32) for _ in range(20)]
    blocks += [np.tile(rng.integers(0, 300, 40), 50).astype(np.int32)]
    coded = range_coder.encode_blocks(blocks)
    back = range_coder.decode_blocks(coded, [len(b) for b in blocks])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back))
    assert len(coded[-1]) < 400 and len(coded[4]) < 200
    # A block's code doesn't depend on its neighbours.
    assert range_coder.encode_blocks(blocks[3:5]) == coded[3:5]


def test_joined_checksums():
    rng = random.Random(1)
    for _ in range(30):
        a, b = rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.randint(0, 5000))
        assert token_store.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_store_round_trip(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = corpus() + [(700, "a  \n\n b\t\tc  ", None, None), (701, "x\u00a0 y <|endoftext|> z\u2028\n", None, None)]
    rows += [(702, "don't  \r\n stop'll \n", None, None), (None, "no id", None, None), (700, "again", None, None)]
    tokenizer = Tokenizer.from_file(path)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for key, text, *_ in order:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    store = str(tmp_path / "store")
    token_store.write_tokens(table(spark, rows), store, path)
    got = [tuple(r) for r in token_store.read_digests(spark, store).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    pieces = sorted(map(tuple, token_store.read_tokens(spark, store).collect()), key=lambda r: (r[1], r[2]))
    joined = {}
    for key, begin, _, ids in pieces:
        joined[begin] = joined.get(begin, b"") + bytes(ids)
    assert {k: zlib.crc32(v) for k, v in joined.items()} == {r[1]: r[3] for r in want}


def test_damaged_block_is_found(spark, tmp_path):
    block = range_coder.encode_blocks([np.arange(50, dtype=np.int32)])[0]
    body = token_store._body(np.arange(50, dtype=np.int32), block, np.array([[0, 1, 0, 50, 2]]))
    assert token_store._open(body)[0] == 50
    with pytest.raises(ValueError, match="damaged"):
        token_store._open(body[:-1] + bytes([body[-1] ^ 1]))


def test_token_store_of_an_empty_table(spark, tmp_path):
    import public_tokenizers

    token_store.write_tokens(table(spark, []), str(tmp_path / "s"), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.read_digests(spark, str(tmp_path / "s")).count() == 0
