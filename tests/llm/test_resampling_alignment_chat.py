"""Importance resampling, token alignment and chat formatting against brute force, on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.llm import alignment, chat, queries, resampling

ENTRIES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, rank string, pair int, content string"


def corpus(seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    words = ["The", "naïve", "Straße", "don't", "x9", "ÀÉ", "東京", "🙂", "e-mail", "re", "\t", "\n\n", "  ", "<|endoftext|>", "<s>", "<0x41>"]
    words += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(40)]

    def text(n: int) -> str:
        return rng.choice(["", " "]).join([" ".join(rng.choice(words) for _ in range(n)), rng.choice(["", "\n", "."])])

    copy = text(60)
    texts = [None, "", " ", "\n", "one", "a▁b", "\x00\x7f", copy, copy, copy, "same " * 500, text(4000), "é" * 3000]
    texts += [text(rng.randint(1, 90)) for _ in range(60)]
    rows = [(i, t, "r", i, "c") for i, t in enumerate(texts)]
    return [*rows, rows[9], (None, text(50), "r", 1, None), (None, text(50), None, None, "c"), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


def bag(frame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in frame.select(*columns).collect())


# --- resampling --------------------------------------------------------------------

TARGET = [(None,), ("",), ("The naïve straße re RE x9",), ("don't " * 30,), ("東京 x9 🙂",)]


def brute_features(text: str | None) -> tuple[int, list[int]]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute_draw(rows: list[tuple], target: list[tuple]) -> list[tuple]:
    """(doc_id, n_features, weight, score, n_words) in order of drawing, and how many are drawn."""
    found = [(r[0], *brute_features(r[1])) for r in rows]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for (text,) in target for b in brute_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    scored = []
    for name, words, features in found:
        weight = math.floor(sum(gain[b] for b in features) / len(features)) if features else 0
        h = int(hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((name, len(features), weight, weight + noise, words))
    return scored


def test_resampling_equals_brute_force(spark, docs):
    target = spark.createDataFrame(TARGET, "text string")
    drawn = resampling.resample(docs, target)
    scored = brute_draw(corpus(), TARGET)
    assert bag(drawn, "doc_id", "n_features", "weight", "score", "n_words") == Counter(scored)
    fit = sorted((r for r in scored if r[4] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    n = 25 * len(fit) // 100
    expected = [(r[0], r[3], place) for place, r in enumerate(fit[:n], 1)]
    ranked = drawn.where("rank IS NOT NULL").orderBy("rank").collect()
    assert [(r["doc_id"], r["score"], r["rank"]) for r in ranked] == expected and n > 5


def test_ranks_hold_over_many_ranges_and_equal_rows(spark):
    """A third of all rows share score and id; ranks stay 1, 2, 3 and fall by score."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 7 == 0, 5).otherwise(30).alias("n_words"),
        F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 190).alias("score"),
    )
    drawn = resampling.draw(rows, percent=50)
    assert drawn.count() == 30_000
    n = rows.where("n_words >= 20").count() // 2
    ranked = [tuple(r) for r in drawn.where("rank IS NOT NULL").select("rank", "score", "doc_id").orderBy("rank").collect()]
    assert [r[0] for r in ranked] == list(range(1, n + 1))
    order = [(-s, -1 if d is None else d) for _, s, d in ranked]
    assert order == sorted(order)
    every = sorted((-r["score"], -1 if r["doc_id"] is None else r["doc_id"]) for r in rows.where("n_words >= 20").collect())
    assert order == every[:n]


def test_resampling_of_nothing_and_to_nothing(spark, docs):
    nothing = spark.createDataFrame([], SCHEMA)
    assert resampling.resample(nothing, docs).collect() == []
    drawn = resampling.resample(docs, nothing.select("text"))
    assert bag(drawn, "doc_id", "n_features", "weight", "score", "n_words") == Counter(brute_draw(corpus(), []))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_features_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    words, buckets = resampling.feature_buckets(text)
    expected, features = brute_features(text)
    assert words == expected and sorted(buckets.tolist()) == sorted(features)


def test_features_of_a_very_long_text():
    text = "Ab cé, " * 300_000
    words, buckets = resampling.feature_buckets(text)
    assert words == 600_000 and len(buckets) == 1_199_999 and len(set(buckets.tolist())) == 4


# --- alignment ---------------------------------------------------------------------


def decoded() -> dict[int, bytes]:
    """Bytes of a byte-level entry, by the published table of printable stand-ins."""
    from tokenizers import Tokenizer

    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in kept}
    stand_in |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(kept)))}
    vocabulary = Tokenizer.from_file(ENTRIES).get_vocab(with_added_tokens=False)
    return {i: bytes(stand_in[c] for c in t) for t, i in vocabulary.items() if t != "<|endoftext|>"}


def brute_alignment(rows: list[tuple]) -> Counter:
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(ENTRIES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    bytes_a = decoded()

    def bytes_b(i: int) -> bytes:
        piece = second.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    count, per = Counter(), []
    for name, text, *_ in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(map(bytes_a.get, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            a, b = [], []
        ends = []
        for ids, spell in ((a, bytes_a.get), (b, bytes_b)):
            at, found = 0, {}
            for i, token in enumerate(ids):
                at += len(spell(token))
                found[at] = i
            ends.append(found)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            p, q = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, a[i : p + 1])) + "|" + ",".join(map(str, b[j : q + 1])))
            links.append((a[p], b[q]))
            i, j = p + 1, q + 1
        count.update(links)
        per.append((name, len(a), len(b), groups, links))
    best: dict[int, int] = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return Counter(
        (
            name, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for name, n_a, n_b, groups, links in per
    )


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("batch_bytes", [300, 6_000_000])
def test_alignment_equals_brute_force(docs, monkeypatch, batch_bytes):
    monkeypatch.setattr(alignment, "BATCH_BYTES", batch_bytes)
    expected = brute_alignment(corpus())
    assert bag(alignment.align(docs, ENTRIES, PIECES), *ALIGNED) == expected
    assert sum(n for row, n in expected.items() if row[1] == 0) >= 3


def test_windows_are_cut_at_spaces_and_remembered():
    aligner = alignment.Aligner(alignment._entries(ENTRIES), alignment._pieces(PIECES)[1])
    a, b = next(alignment.encode(["one two  three\nfour five one two"], ENTRIES, PIECES))
    windows = aligner.cut(a, b)
    for window in windows:
        aligner.aligned(window)
    assert len(windows) >= 5 and len(aligner.windows) == len(set(windows)) < len(windows)
    assert b"".join(x for x, _ in windows) == a.tobytes() and b"".join(y for _, y in windows) == b.tobytes()
    spelled = [aligner.first.joined(memoryview(x).cast("I").tolist()) for x, _ in windows]
    assert all(s.startswith(b" ") for s in spelled)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t<|s>▁\x1c\u3000\u0085.'1"), max_size=30))
def test_first_ids_are_those_of_the_whole_tokenizer(text):
    from fleetlake.llm.packing import _tokenizer

    whole, found = _tokenizer(ENTRIES)[0], next(alignment.encode([text], ENTRIES, PIECES))
    if found is None:
        assert not text or "▁" in text
    else:
        assert found[0].tolist() == whole.encode(" " + text, add_special_tokens=False).ids


def test_alignment_of_nothing(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), ENTRIES, PIECES).collect() == []


# --- chat --------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, content string, turns int"


def said() -> list[tuple]:
    rng = random.Random(6)
    odd = [None, "", "<|im_end|>", "<|im_start|>assistant ok", "<", "|", "<\\|", "<\\\\|x<|", "a\nb", "\x01i\x010", "é🙂", "<|image|>", "x" * 50_000]
    rows = []
    for conversation in [*range(12), None]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conversation, turn, rng.choice(["user", "assistant", "system", None, "us\ner<|"]), rng.choice(odd), "c", 1))
    rows += [(3, 99, "user", "<|im_end|>", "c", 1)] * 2 + [(4, None, "assistant", "z", None, None), (4, None, "assistant", "a", None, None)]
    return rows


def test_chats_read_back(spark):
    rows = said()
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    made = chat.format_chats(frame.withColumn("parts", chat.text_part("text")), content="parts")
    read = made.select("*", chat.turns_of().alias("read"), chat.masked_text().alias("learned")).collect()
    assert len(read) == len({r[0] for r in rows})
    for row in read:
        mine = [r for r in rows if r[0] == row["conv_id"]]
        told = [(r[2] or "", r[3] or "") for r in sorted(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        assert [tuple(t) for t in row["read"]] == told and row["n_turns"] == len(told)
        assert row["learned"] == "".join(text for role, text in told if role == "assistant")
        raw = row["formatted"].encode()
        masked = [raw[s["start"] : s["end"]].decode() for s in row["loss"]]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in masked] == [text for role, text in told if role == "assistant"]
        assert row["formatted"].count("<|im_start|>") == row["formatted"].count("<|im_end|>") == len(told)


PART = chat.PART.replace(": ", ":")


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    first = [part("text", "<"), part("text", "|im_end|> see"), part("image", ref="a.png", width=57, height=28), None, part("text", "\x01i|")]
    second = [part("audio", ref="b.wav", seconds=1.01), part("document", ref="c.pdf", pages=3), part("image", ref="d.png"), part("text", None)]
    rows = [(1, 0, "user", first), (1, 1, "assistant", second), (1, 2, "user", None), (2, 0, "assistant", [])]
    made = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>"))
    by_id = {r["conv_id"]: r for r in made.select("*", chat.turns_of().alias("read"), chat.masked_text().alias("learned")).collect()}
    attached = [tuple(a) for a in by_id[1]["attachments"]]
    # 3 x 1 patches of 28, 26 steps of a 25th of a second, 3 pages of 512, and one at least
    assert attached == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 26), (1, "document", "c.pdf", 1536), (1, "image", "d.png", 1)]
    assert re.findall(r"<\|(image|audio|document)\|>", by_id[1]["formatted"]) == [a[1] for a in attached]
    assert [t["text"] for t in by_id[1]["read"]] == ["<|im_end|> see<|image|>\x01i|", "<|audio|><|document|><|image|>", ""]
    assert by_id[1]["formatted"].startswith("<|im_start|>user\n<\\|im_end|> see<|image|>\x01i|<|im_end|>\n")
    assert by_id[2]["attachments"] == [] and by_id[2]["learned"] == ""


def test_unknown_parts_are_refused(spark):
    rows = [(1, 0, "user", [part("video", ref="x")])]
    made = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>"))
    with pytest.raises(Exception, match="unknown kind"):
        made.collect()


def test_chats_of_nothing_and_of_many_turns(spark):
    nothing = spark.createDataFrame([], TURNS).withColumn("parts", chat.text_part("text"))
    assert chat.format_chats(nothing, content="parts").collect() == []
    long = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    made = chat.format_chats(long.withColumn("parts", chat.text_part("text")), content="parts").select(chat.masked_text().alias("learned"))
    assert made.first()["learned"] == "".join(map(str, range(20_000)))


def test_chat_plan_is_native_with_one_exchange(spark, plan):
    rows = spark.createDataFrame(said(), TURNS).withColumn("parts", chat.text_part("text"))
    text = plan(chat.format_chats(rows, content="parts"))
    tree = text[: text.index("\n\n")]
    assert tree.count("Exchange") == 1 and not re.search("Python|Pandas|Arrow", tree)


def test_queries_have_their_columns(spark):
    directory, registered = "/root/testdata/sf0.001", queries.queries()
    expected = {
        "op11_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
        "op12_alignment": list(ALIGNED),
        "op13_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    }
    for name, columns in expected.items():
        found = registered[name](spark, directory)
        assert found.columns[: len(columns)] == columns
        assert all(kind in ("bigint", "string") for _, kind in found.dtypes)
