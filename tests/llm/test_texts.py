"""Codecs, token files, token counts and language models against libraries and plain versions."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evidentia.llm import langid, pieces, token_counts, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return pieces.codec(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def strings(names, count, seed=1):
    draw = random.Random(seed)
    some = [*"ab eortin▁  \t\n019.,'é日本\U0001d4b3́\x00", *draw.sample(names, 2000)]
    for _ in range(count):
        yield "".join(draw.choice(some) for _ in range(draw.randint(0, 14)))
    for n in (1, 2, 14, 15, 16, 17, 31, 40):
        yield " " * n
        yield "a" + " " * n + "b" + " " * n + "\n" + " " * n + "1"
    yield "ab" * 5000
    yield "<s></s><unk><0x41>"


def test_ids_and_texts_equal_the_library(codec, library):
    for text in strings(list(codec.ids), 5000):
        want = library.encode(text, add_bos=True, add_eos=True)
        got = codec.encode(text)
        assert got.tolist() == want, text
        assert codec.decode(got) == library.decode(want), text


def test_each_prefix_has_its_last_token(codec, library):
    for text in ("▁international", "▁abracadabra", "ththationer", "▁Übermut"):
        for end, token in enumerate(codec.last_tokens(text), 1):
            want = library.encode_as_pieces(text[:end].replace("▁", "")) if text[0] == "▁" and end > 1 else None
            assert want is None or codec.names[token] == want[-1]


def test_tokenising_odd_and_no_documents(odd_documents, no_documents, library):
    rows = pieces.tokenise(odd_documents, PIECES)
    assert set(rows.columns) == {*odd_documents.columns, "ids", "n_tokens", "decoded"}
    for r in rows.withColumn("again", pieces.decoder(PIECES)("ids")).collect():
        want = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == r["again"] == library.decode(want)
    assert pieces.tokenise(no_documents, PIECES).count() == 0


# -- token files -------------------------------------------------------------------------


@pytest.mark.parametrize("top", [2, 256, 49408, 1 << 32])
def test_codes_give_every_token_back(top):
    for size in (0, 1, 511, 512, 513, 5000):
        ids = np.random.default_rng(size).integers(0, top, size, dtype=np.uint64).astype(np.uint32)
        codes = token_files.Codes(token_files.pack(ids))
        assert len(codes) == size and (codes.read(0, size) == ids).all()
        for p in range(0, size, 37):
            assert codes.get(p) == ids[p]
            assert (codes.read(p, min(size, p + 700)) == ids[p : p + 700]).all()
        with pytest.raises(IndexError):
            codes.get(size)


def test_files_hold_documents_in_order(spark, odd_documents):
    model = Tokenizer.from_file(WORDS)
    texts = ["Hello  WORLD's", "", "É\x1cé\x1d x", "<|endoftext|>a b", "a b c\x85d", "x" * 3000, "İstanbul ΣΑΣ", "ed́ é"]
    docs = spark.createDataFrame([(50 - i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    docs = docs.unionByName(odd_documents.select("doc_id", "text"))
    folder = token_files.write_files(docs, WORDS, segment_tokens=700)
    got = token_files.read_documents(spark, folder).orderBy("start").collect()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    every = []
    for r, g in zip(rows, got, strict=True):
        ids = [*model.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids"]) == (r["doc_id"], len(every), len(ids), ids)
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        every += ids
    wanted = [0, 1, 699, 700, 701, len(every) - 1, len(every), 5, 5]
    found = token_files.tokens_at(spark, folder, spark.createDataFrame([(p,) for p in wanted], "position long")).collect()
    assert sorted(map(tuple, found)) == sorted({(p, every[p]) for p in wanted if p < len(every)})


def test_pre_tokens_of_plain_and_other_texts_equal_the_library():
    pick = random.Random(5)
    plain = ["'", "s", "t", "re", "ve", "ll", "d", "m", "l", " ", "  ", "\n", "\t", "1", "23", "!", '"', "É", "é", "ß", "A", "Q", "-", "ÿ", "s" * 60]
    other = [*plain, "<|", "×", "中", "\x1c", "\x0b", "😀"]
    texts = ["".join(pick.choices(plain, k=pick.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(pick.choices(other, k=pick.randint(0, 14))) for _ in range(3000)] + [None, "", "a'" * 3000]
    pick.shuffle(texts)
    model = Tokenizer.from_file(WORDS)
    wanted = [np.array(e.ids, "<u4").tobytes() for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    tokenizer = token_files.WordTokenizer(WORDS)
    assert list(tokenizer.batch(texts)) == wanted
    assert list(tokenizer.batch(texts)) == wanted  # from the caches
    assert list(tokenizer.batch([])) == []


def test_files_of_no_documents(spark, no_documents):
    folder = token_files.write_files(no_documents, WORDS)
    assert token_files.read_documents(spark, folder).count() == 0


# -- token counts --------------------------------------------------------------------------


def plain_count(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            piece = word[start:end]
            if piece in model.score:
                options.append((best[start][0] + model.score[piece], best[start][1] - 1))
            elif len(piece) == 1:
                n = len(piece.encode())
                options.append((best[start][0] + n * model.lowest, best[start][1] - n))
        best.append(max(options))
    return -best[-1][1]


def test_counts_equal_a_plain_search(spark, odd_documents):
    model = token_counts.UnigramCounter(PIECES)
    words = sorted({token_counts.MARK + w for t in strings(list(model.score), 400) for w in t.split()} - {token_counts.MARK + "ab" * 5000})
    assert model.counts(words) == [plain_count(model, w) for w in words]
    rows = token_counts.count_tokens(odd_documents, PIECES)
    for r in rows.where("doc_id not in (6, 7) or doc_id is null").collect():
        own = (r["text"] or "").encode().split()
        assert r["n_words"] == len(own)
        assert r["n_tokens"] == sum(plain_count(model, token_counts.MARK + w.decode()) for w in own)
    assert rows.count() == 11
    assert token_counts.count_tokens(odd_documents.limit(0), PIECES).count() == 0


# -- language identification -------------------------------------------------------------------


def plain_probability(counts, gram):
    """Interpolated Kneser-Ney by its definition, for counts of 4-grams (strings) of one language."""
    tables = {4: dict(counts)}
    for n in (3, 2, 1):
        lower = {}
        for g, c in tables[n + 1].items():
            if c:
                lower[g[1:]] = lower.get(g[1:], 0) + 1
        tables[n] = lower

    def p(g):
        n = len(g)
        if not n:
            return 2.0**-16
        t = tables[n]
        ones, twos = sum(c == 1 for c in t.values()), sum(c == 2 for c in t.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        follow = [c for x, c in t.items() if x[:-1] == g[:-1]]
        if not follow:
            return p(g[1:])
        return max(t.get(g, 0) - d, 0) / sum(follow) + d * len(follow) / sum(follow) * p(g[1:])

    return p(gram)


def test_probabilities_equal_the_definition():
    texts = {"x": "the cat sat on the mat the end", "y": "le chat est sur le tapis la fin"}
    tables = {}
    for i, text in enumerate(texts.values()):
        keys, counts = np.unique(langid.ngrams([text])[0], return_counts=True)
        for k, c in zip(keys.tolist(), counts.tolist()):
            tables.setdefault(k, [0, 0])[i] = c
    keys = np.array(sorted(tables), np.uint64)
    model = langid.kneser_ney(["x", "y"], keys, np.array([tables[k] for k in keys.tolist()], float))
    name = lambda k: "".join(chr(int(k) >> 16 * i & 0xFFFF) for i in (3, 2, 1, 0))
    asked = np.r_[keys, langid.ngrams(["zebra the chat matin"])[0]]
    got = np.exp(model.log_probabilities(asked).astype(float))
    for i in range(2):
        counts = {name(k): v[i] for k, v in tables.items() if v[i]}
        for k, row in zip(asked, got):
            assert row[i] == pytest.approx(plain_probability(counts, name(k)), rel=1e-4)


def test_hash_table_finds_all_and_nothing_else():
    draw = np.random.default_rng(2)
    keys = np.unique(draw.integers(0, 1 << 63, 10_000, dtype=np.uint64))
    table = langid.HashTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
    assert langid.HashTable(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


def test_held_out_accuracy_and_rejection(spark):
    draw = random.Random(7)
    sounds = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "tz"], "cc": ["eau", "que", "oi", "le"]}
    word = lambda x: "".join(draw.choice(sounds[x]) for _ in range(draw.randint(1, 4)))
    rows = [(i, " ".join(word(x) for _ in range(40)), x) for i, x in enumerate(draw.choice([*sounds]) for _ in range(1500))]
    noise = [(5000 + i, " ".join("".join(draw.choice("vwxyzqjp") for _ in range(6)) for _ in range(40)), None) for i in range(20)]
    docs = spark.createDataFrame(rows + noise, "doc_id long, text string, lang string")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    got = langid.identify(docs, model).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    real = [r for r in got if r["lang"] and r["out"]]
    assert len(real) > 300 and sum(r["lang_pred"] == r["lang"] for r in real) / len(real) > 0.99
    assert not any(r["rejected"] for r in real) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["rejected"] for r in got if r["lang"] is None)


def test_language_of_odd_and_no_documents(spark, odd_documents, no_documents):
    model = langid.fit(odd_documents)
    rows = langid.identify(odd_documents, model).collect()
    assert len(rows) == 11
    assert {r["doc_id"] for r in rows if r["lang_pred"] == langid.UNKNOWN} == {1, 2, 3}
    assert all(r["rejected"] and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    nothing = langid.fit(no_documents)
    assert nothing.languages == []
    rows = langid.identify(odd_documents, nothing).collect()
    assert {r["lang_pred"] for r in rows} == {langid.UNKNOWN} and all(r["rejected"] and r["score"] == 0 for r in rows)


def test_the_bound_on_the_model_leaves_rare_grams_to_lower_orders(spark):
    docs = spark.createDataFrame([("abcdefgh " * 50, "x"), ("stuvwxyz " * 50 + "q", "y")], "text string, lang string")
    small = langid.fit(docs, max_cells=30)
    whole = langid.fit(docs)
    assert len(small.grams[4][1]) <= 15 < len(whole.grams[4][1])
    assert math.isfinite(float(small.log_probabilities(langid.ngrams(["never seen"])[0]).sum()))


def test_no_gram_is_lost_beyond_the_bound_on_the_broadcast(spark):
    draw = random.Random(3)
    word = lambda letters: "".join(draw.choice(letters) for _ in range(draw.randint(1, 6)))
    rows = [(i, " ".join(word(x) for _ in range(30)), x) for i, x in enumerate(draw.choice(["abcdefg", "efghijk", "ijklmno"]) for _ in range(300))]
    rows += [(900 + i, t, None) for i, t in enumerate([None, "", "123", "never seen \U0001d54f", rows[0][1], rows[0][1]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, small = langid.fit(docs), langid.fit(docs, max_cells=600)
    assert 0 < len(small.grams[4][1]) <= 200 < len(whole.grams[4][1])
    want = {r["doc_id"]: r for r in langid.identify(docs, whole).collect()}
    got = langid.identify(docs, small).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["lang_pred"], r["rejected"]) == (w["lang_pred"], w["rejected"])
        assert r["cross_entropy"] == pytest.approx(w["cross_entropy"], rel=1e-4) and r["score"] == pytest.approx(w["score"], rel=1e-3)


@pytest.mark.parametrize("rows_of", [{"aa": 40, "bb": 40, "cc": 40}, {"aa": 900, "bb": 900, "cc": 9}])
def test_gibberish_is_rejected_whatever_the_share_of_a_language(spark, rows_of):
    draw = random.Random(11)
    sounds = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "tz"], "cc": ["eau", "que", "oi", "le"]}
    text = lambda x: " ".join("".join(draw.choice(sounds[x]) for _ in range(draw.randint(1, 4))) for _ in range(60))
    rows = [(text(x), x, True) for x, n in rows_of.items() for _ in range(n)]
    noise = [" ".join("".join(draw.choice(letters) for _ in range(6)) for _ in range(40)) for letters in ("vwxyzqjp", "eauoqil", "жщюяы")]
    docs = spark.createDataFrame(rows + [(x, None, False) for x in noise], "text string, lang string, real boolean")
    model = langid.fit(docs)
    assert model.languages == ["aa", "bb", "cc"] and np.isfinite(model.slack).all()
    got = langid.identify(docs, model).collect()
    assert [r["rejected"] for r in got if not r["real"]] == [True] * 3
    assert not any(r["rejected"] for r in got if r["real"])


def test_rare_languages_are_in_the_calibration(spark):
    rows = spark.range(80_000).selectExpr("if(id < 400, 'rare', 'hot') lang", "string(id) text")
    shares = langid.shares(rows, 5000)
    assert 400 * shares["rare"] >= 59 and 79_600 * shares["hot"] <= 2501


def test_copies_are_calibrated_on_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "calibrate", lambda model, sample: seen.extend(sample.collect()))
    rows = [(f"text number {i % 40} of many", "aa") for i in range(4000)] + [("text number 1 of many", "bb")] * 50 + [("more", "bb")]
    langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert 0 < len(seen) == len({(r["lang"], r["text"]) for r in seen})


def test_no_language_loses_all_its_rows_to_the_calibration(spark):
    rows = [(f"the only text of {i}", f"l{i:02}") for i in range(24)]
    assert langid.fit(spark.createDataFrame(rows, "text string, lang string")).languages == [x for _, x in rows]


def test_signs_beyond_the_first_plane_are_no_letters(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat of the house", "en"), ("le chat de la maison", "fr")] * 40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "\U0001f600\U0001f600 !!"), (2, "\U0001f600 the house of the cat \U0001f600"), (3, "\U0001d4b3\U00020000")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert (got[1]["lang_pred"], got[1]["score"], got[1]["rejected"]) == ("und", 0.0, True)
    assert got[2]["lang_pred"] == "en" and got[3]["lang_pred"] != "und"
