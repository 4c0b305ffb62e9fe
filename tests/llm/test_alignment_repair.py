"""Byte-level BPE, alignment and conversation repair against libraries and plain versions."""

import bisect
import hashlib
import heapq
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evidentia.llm import alignment, conversations, merge_automaton, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def u32(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# -- byte-level BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(BYTES)
    model.no_truncation()
    model.no_padding()
    return model


def strings(count, seed=5):
    draw = random.Random(seed)
    some = [*"ab eortinsx  \t\n019.,'é日本\U0001d4b3́\x00\x1c\x85\xa0​　", "<|endoftext|>", "'s", "'ll", "  ", " the", "Über", "ation"]
    some += [chr(draw.randrange(1, 0xD800)) for _ in range(300)] + [chr(draw.randrange(0x10000, 0x110000)) for _ in range(100)]
    for _ in range(count):
        yield "".join(draw.choice(some) for _ in range(draw.randint(0, 16)))
    yield from ("a" * 50_000, "aaaa " * 3000, " " * 3000, "\n \n  x " * 300, "ab" * 4001, "I'll  go's \r\n\r\n x ")


def test_ids_and_texts_equal_the_library(library):
    own = merge_automaton.codec(BYTES)
    for text in strings(8000):
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert got.tolist() == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False), text


def test_every_character_is_cut_as_the_library_does(library):
    own = merge_automaton.codec(BYTES)
    for at in (*range(0, 0x34000, 64), *range(0x3C000, 0x110000, 0x1000)):
        text = "".join(f"x{chr(c)}1{chr(c)} {chr(c)}{chr(c)}" for c in range(at, at + 64) if not 0xD800 <= c < 0xE000)
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(at)


def plain_merges(parts, ranks):
    """Merging by rank, leftmost first."""
    while True:
        options = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not options:
            return parts
        at = min(options)[1]
        parts = parts[:at] + [parts[at] + parts[at + 1]] + parts[at + 2 :]


def test_automaton_accepts_what_merging_gives():
    draw = random.Random(2)
    for _ in range(60):
        names, merges = ["a", "b", "c"], []
        for _ in range(draw.randint(1, 12)):
            pair = draw.choice(names), draw.choice(names)
            if "".join(pair) not in names:
                names.append("".join(pair))
                merges.append(pair)
        ids = {n: i for i, n in enumerate(names)}
        ranks = {p: k for k, p in enumerate(merges)}
        auto = merge_automaton.Automaton({i: n.encode() for n, i in ids.items()}, [(ids[a], ids[b], ids[a + b]) for a, b in merges])
        for _ in range(60):
            word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 9)))
            want = [ids[p] for p in plain_merges(list(word), ranks)]
            state, paths = auto.start, [(0, auto.start, [])]
            found = []
            while paths:
                at, state, path = paths.pop()
                if at == len(word):
                    found.append(path)
                for label, token in auto.formed.items():
                    if word.startswith(label.decode(), at) and auto.arc(state, token):
                        paths.append((at + len(label), auto.target[token], [*path, token]))
            assert found == [want], (word, merges)


def test_byte_bpe_of_odd_and_no_documents(odd_documents, no_documents, library):
    rows = merge_automaton.tokenise(odd_documents, BYTES)
    assert set(rows.columns) == {*odd_documents.columns, "ids", "n_tokens", "decoded"}
    for r in rows.withColumn("again", merge_automaton.decoder(BYTES)("ids")).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == r["again"] == library.decode(want, skip_special_tokens=False)
    assert merge_automaton.tokenise(no_documents, BYTES).count() == 0


def test_byte_bpe_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op11_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(want), sha(u32(want)), sha(text.encode()))


# -- conversations ----------------------------------------------------------------------------


def plain_repair(rows):
    """Cheapest legal edits by a search over whole strings: cost first, then ASCII."""
    seen, faults = set(), []
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, out = heapq.heappop(queue)
        if (at, last) in done:
            continue
        if at == len(rows) and last in ("", "a"):
            break
        done.add((at, last))
        for role in ("user", "assistant"):
            if role[0] in follow[last]:
                heapq.heappush(queue, (cost + 5, audit + "I", at, role[0], (*out, f"{role}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, last, out))
            if faults[at] in ("", "truncated"):
                extra = 5 if faults[at] else 0
                if role[:1] and role[0] in follow[last]:
                    heapq.heappush(queue, (cost + extra, audit + "K", at + 1, role[0], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in follow[last]:
                        heapq.heappush(queue, (cost + extra + 1, audit + "R", at + 1, new[0], (*out, f"{new}:{text}")))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        sha("\n".join(out).encode()),
    )


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        out[conv]
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        if fault:
            out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def same_as_plain(df, rows, **bounds):
    got = conversations.repair(conversations.damage(df), **bounds).collect()
    want = plain_damage(rows)
    assert sorted([str(r["conv_id"]) for r in got]) == sorted(map(str, want))
    for r in got:
        assert tuple(r)[1:] == plain_repair(want[r["conv_id"]]), (r["conv_id"], want[r["conv_id"]])


def drawn(count, seed):
    draw = random.Random(seed)
    texts = ["A b.", "c d", "e!", "", " \t", "f?  ", "g. \n", "same.", "same.", "h \x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ux", None]
    rows = []
    for conv in range(count):
        size = draw.choice([0, 1, 2, 3, 5, 9, 30])
        turns = draw.choice([list(range(size)), [None] * size, [draw.randint(0, 9) for _ in range(size)]])
        rows += [(None if conv == 7 else conv, t, draw.choice(roles), draw.choice([*texts, None])) for t in turns]
    return rows


CONVERSATION = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bounds", [{}, {"block_rows": 3}, {"block_rows": 1, "block_characters": 5}])
def test_repairs_equal_a_plain_search(spark, bounds):
    rows = drawn(160, 4)
    df = spark.createDataFrame(rows, CONVERSATION).repartition(3).withColumn("audit", F.lit(1)).withColumn("part", F.lit("x"))
    same_as_plain(df, rows, **bounds)


def test_hot_conversation_lies_in_many_blocks(spark):
    draw = random.Random(8)
    rows = [(1, t, draw.choice(["user", "assistant"]), draw.choice(["A b.", f"{t} x.", f"{t} y"])) for t in range(1500)]
    rows += [(1, 700, "user", "again.")] * 300 + [(2, 0, "user", "Q?"), (2, 1, "assistant", "A.")]
    same_as_plain(spark.createDataFrame(rows, CONVERSATION).repartition(4), rows, block_rows=64)


def test_walk_keeps_checkpoints_only():
    draw = random.Random(1)
    codes = bytes(draw.randrange(16) for _ in range(1000))
    assert len(conversations.backward(codes, list(conversations.END), 31)) == 34
    whole, state = conversations.walk(codes, list(conversations.END), 0)
    for cut in (1, 400, 999):
        end = conversations.backward(codes[cut:], list(conversations.END), 1)[0]
        first, middle = conversations.walk(codes[:cut], end, 0)
        second, last = conversations.walk(codes[cut:], list(conversations.END), middle)
        assert (first + second, last) == (whole, state)
        between = conversations.costs_between(codes[:cut])
        total = conversations.backward(codes, list(conversations.END), 1)[0]
        assert [min(between[4 * s + e] + end[e] for e in range(4)) for s in range(4)] == total


def test_no_conversations(spark):
    assert conversations.repair(conversations.damage(spark.createDataFrame([], CONVERSATION))).count() == 0


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_damage(rows)
    got = queries.op12_conversation_repair(spark, SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == plain_repair(want[r["conv_id"]])


# -- alignment --------------------------------------------------------------------------------


def next_common(common, end):
    return common[bisect.bisect_left(common, end)]


def plain_alignment(texts):
    """Tokens by the libraries, links by comparing byte ranges."""
    a_model = Tokenizer.from_file(BYTES)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte = merge_automaton.byte_names()
    rows, held = [], Counter()
    for text in texts:
        a = a_model.encode(" " + text, add_special_tokens=False) if text else None
        a_bytes = [bytes(byte[c] for c in t) for t in a.tokens] if a else []
        b = b_model.encode(text) if text else []
        names = [b_model.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(n[3:5], 16)]) if b_model.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
        a_ids = a.ids if a else []
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
            rows.append(None)
            continue
        spans = []
        for parts in (a_bytes, b_bytes):
            ends = np.cumsum([len(p) for p in parts])
            spans.append(list(zip([0, *ends[:-1]], ends)))
        links, first = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < e:
                links.append((a_ids[i], b[j]))
                j += 1
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        sides = []
        for ids, span in zip((a_ids, b), spans):
            of_group = defaultdict(list)
            for token, (_, end) in zip(ids, span):
                of_group[next_common(common, end)].append(str(token))
            sides.append(of_group)
        groups = [",".join(sides[0][e]) + "|" + ",".join(sides[1][e]) for e in common]
        held.update(set(links))
        rows.append((len(a_ids), len(b), len(groups), links, ";".join(groups)))
    top = Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(held[p] == top[p[0]] for p in r[3])
        out.append((*r[:3], len(r[3]), best, sum(held[p] for p in r[3]), sha(r[4].encode())))
    return out


def test_pieces_of_the_merge_give_all_links():
    draw = random.Random(9)
    for _ in range(300):
        size = draw.randint(1, 60)
        a, b = (np.array(sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size})) for _ in range(2))
        whole = alignment.links(a, b)
        ends = sorted({*a, *b})
        assert whole[0].tolist() == np.searchsorted(a, ends).tolist() and whole[1].tolist() == np.searchsorted(b, ends).tolist()
        assert whole[2].tolist() == [e in a and e in b for e in ends]
        for piece in (1, 2, 3, 7):
            for x, y in zip(whole, alignment.links(a, b, piece)):
                assert x.tolist() == y.tolist()


def test_alignment_of_odd_and_no_documents(spark, odd_documents, no_documents):
    texts = [t[:3000] for t in strings(300, seed=6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    docs = docs.unionByName(odd_documents.select("doc_id", "text"))
    rows = docs.collect()
    want = sorted(map(str, zip([r["doc_id"] for r in rows], plain_alignment([r["text"] for r in rows]))))
    for known in (0, 40, alignment.KNOWN_PAIRS):
        got = alignment.link_documents(docs.withColumn("pairs", F.lit(1)), BYTES, PIECES, known).collect()
        assert sorted(str((r[0], tuple(r)[1:])) for r in got) == want
    assert alignment.link_documents(no_documents, BYTES, PIECES).count() == 0
    shown = alignment.align(docs, BYTES, PIECES, piece=5).collect()
    assert all(sha(r["groups"].encode()) == r["groups_sha256"] for r in shown if r["n_a"])


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = dict(zip([r["doc_id"] for r in docs], plain_alignment([r["text"] for r in docs])))
    got = queries.op13_token_alignment(spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(docs)
