from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
import zstandard
from brute import base_spans, contamination, corner_rows, frame, rows_of
from pyspark.sql import functions as F

from sparkpact.llm import contamination as cont
from sparkpact.llm import language, secret_scan

# -- language --------------------------------------------------------------------


def prose(seed, alphabet, n=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randrange(2, 8))) for _ in range(n // 5)) + "."


ALPHABETS = {"aa": "abcde", "bb": "fghij", "cc": "klmnoé", "dd": "pqrstß", "ee": "uvwxyzñ"}


def labelled(n=40):
    langs = list(ALPHABETS)
    return [(i, prose(i, ALPHABETS[langs[i % len(langs)]]), langs[i % len(langs)]) for i in range(n * len(langs))]


def test_languages_are_told(spark):
    rows = labelled()
    docs = frame(spark, rows + [(5000, None, "aa"), (5001, "12 34 !", "aa"), (5002, "", None), (5003, prose(1, "fghij"), None), (None, prose(2, "abcde"), "bb")])
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    truth = {i: lang for i, _, lang in rows}
    assert all(found[i]["lang_pred"] == lang for i, lang in truth.items())
    assert {i for i in truth if found[i]["held_out"]} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert [found[i]["lang_pred"] for i in (5000, 5001, 5002, 5003)] == ["und", "und", "und", "bb"]
    assert found[None]["lang_pred"] == "aa"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_labels_ids_and_neighbours_do_not_matter(spark):
    """A prediction is a function of the text: other rows beside it, ids and labels change nothing."""
    rows = labelled(10)
    model = language.fit(frame(spark, rows))
    first = {r["doc_id"]: r["score"] for r in language.predict(frame(spark, rows), model).collect()}
    again = [(i, t, None) for i, t, _ in reversed(rows)]
    second = {r["doc_id"]: r["score"] for r in language.predict(frame(spark, again).repartition(7), model).collect()}
    assert first == pytest.approx(second)


def test_ambiguity_is_flagged(spark):
    model = language.fit(frame(spark, labelled()))
    docs = frame(spark, [(1, "zzqzz 0 xjxjx" if False else "q"), (2, prose(3, "fghij"))])
    found = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert not found[2]["ambiguous"]
    margins = np.zeros((1, len(model.weights)))
    assert model.decode(margins)[2][0]


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 40])
def test_codewords_differ(n):
    words = language.codewords(n)
    assert len(np.unique(words, axis=0)) == n or n == 1
    assert n == 1 or (np.abs(words.sum(axis=0)) < n).all()


def test_one_language_and_none(spark):
    rows = [(i, prose(i, "abcde"), "aa") for i in range(20)]
    assert {r["lang_pred"] for r in language.identify(frame(spark, rows)).collect()} == {"aa"}
    unlabelled = frame(spark, [(1, "some text", None)])
    found = language.identify(unlabelled).first()
    assert (found["lang_pred"], found["score"]) == ("und", 0.0)
    assert language.identify(frame(spark, [])).count() == 0


def test_rejected_rows_go_whole(spark):
    docs = frame(spark, labelled(10) + [(900, None, "aa"), (901, "42", "aa")])
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in labelled(10)}


def test_margins_against_the_nearest_are_ambiguous():
    """One codeword is clearly the nearest, and the margins are against it all the same."""
    model = language.Model(["a", "b", "c"], language.codewords(3), np.zeros((3, language.BUCKETS), np.float32))
    best, score, ambiguous = model.decode(np.array([[-1.5, -1.0, 0.9], [-1.5, 1.0, -0.9]]))
    assert best.tolist() == [1, 1] and (score > 0.4).all()
    assert ambiguous.tolist() == [True, False]
    one = language.Model(["a"], language.codewords(1), np.zeros((0, language.BUCKETS), np.float32))
    assert not one.decode(np.zeros((2, 0)))[2].any()


# -- contamination -----------------------------------------------------------------


def words(n, seed, size=400):
    r = random.Random(seed)
    return [f"{r.choice('abc')}{r.randrange(size)}" for _ in range(n)]


def items():
    return [(0, " ".join(words(40, 1))), (1, " ".join(words(13, 2))), (2, "Short item only"), (3, ""), (4, None), (5, "..."), (10, " ".join(words(60, 3))), (10, "Short item only"), (None, " ".join(words(20, 4)))]


def polluted():
    r, rows = random.Random(9), []
    passages = [words(40, 1), words(13, 2), ["short", "item", "only"], words(60, 3), words(20, 4)]
    for i in range(60):
        own = []
        for _ in range(r.randrange(4)):
            own += words(r.randrange(80), 100 + i)
            if r.random() < 0.5:
                p = r.choice(passages)
                a = r.randrange(len(p))
                own += p[a : a + r.randrange(1, len(p) + 1)]
        rows.append((i, r.choice([" ", ", ", "\n"]).join(w.upper() if r.random() < 0.2 else w for w in own)))
    return rows + corner_rows()


def benchmark(spark):
    return spark.createDataFrame([(*i, "clash") for i in items()], "item_id bigint, text string, items string")


def digest(found):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [16 << 20, 150])
def test_contamination(spark, block_bytes, monkeypatch):
    """One block, and several that are merged."""
    monkeypatch.setattr(cont, "BLOCK_BYTES", block_bytes)
    found = digest(cont.contamination(frame(spark, polluted()), benchmark(spark)))
    assert found == contamination(polluted(), items())
    assert sum(f[-1] for f in found) >= 10


@pytest.mark.parametrize("block_bytes", [16 << 20, 150])
def test_longest_match_and_its_place(spark, block_bytes, monkeypatch):
    """Matches that differ in length in one document and beyond it, against a comparison word by word."""
    monkeypatch.setattr(cont, "BLOCK_BYTES", block_bytes)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = [word.findall((text or "").lower()) for _, text in items()]
    p = words(60, 3)
    rows = polluted() + [(900, " ".join(p[:15] + ["gap"] + p[20:50] + ["gap"] + p[20:50])), (901, " ".join(["x"] + p[40:])), (902, " ".join(p[:12]))]

    def plain(text):
        w, best = word.findall((text or "").lower()), (0, None)
        for a in range(len(w)):
            reach, occurs = 0, False
            for item in own:
                need = min(13, len(item))
                for b in range(len(item)):
                    n = 0
                    while a + n < len(w) and b + n < len(item) and w[a + n] == item[b + n]:
                        n += 1
                    reach, occurs = max(reach, n), occurs or (n >= need and b + need <= len(item))
            if occurs and reach > best[0]:
                best = (reach, a)
        return best

    found = cont.contamination(frame(spark, rows), benchmark(spark)).collect()
    assert sorted(((r["doc_id"], (r["longest"], r["longest_from"])) for r in found), key=repr) == sorted(((r[0], plain(r[1])) for r in rows), key=repr)
    assert {r["doc_id"]: (r["longest"], r["longest_from"]) for r in found if (r["doc_id"] or 0) >= 900} == {900: (30, 16), 901: (20, 1), 902: (0, None)}


def test_words_with_one_hash_are_compared(monkeypatch):
    """With every word under one hash, a block asks for another base, and unequal words are told apart."""
    data, offsets = flat(["alpha beta alpha", "alpha gamma"])
    found = cont.words_of(data, offsets)
    assert cont.same_words(found, np.array([0, 0, 0, 1]), found, np.array([2, 3, 1, 4])).tolist() == [True, True, False, False]
    true, tried = cont.span_hashes, []

    def collide(prefix, begin, end, base):
        tried.append(base)
        return true(prefix, begin, end, base) if len(tried) > 1 else np.zeros(len(begin), np.uint64)

    monkeypatch.setattr(cont, "span_hashes", collide)
    own = cont.Benchmark.of(["0", "1"], data, offsets)
    assert own.base == cont.BASE + 2 and tried == [cont.BASE, cont.BASE + 2] and len(own.vocabulary) == 3


def test_decontaminate(spark):
    docs = frame(spark, polluted())
    kept = cont.decontaminate(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"],) for r in kept.collect()), key=repr) == sorted(((c[0],) for c in contamination(polluted(), items()) if not c[-1]), key=repr)


def test_suffix_array():
    r = random.Random(1)
    for n, depth in ((1, 3), (50, 4), (300, 13), (300, 60)):
        symbols = np.array([r.randrange(3) for _ in range(n)])
        order = cont.suffix_array(symbols, depth)
        assert sorted(order.tolist()) == list(range(n))
        keys = [tuple(symbols[i : i + depth]) for i in order]
        assert keys == sorted(keys)


def test_longest_matches():
    r = random.Random(3)
    text = " ".join(r.choice("xyz") for _ in range(300))
    item = " ".join(r.choice("xyz") for _ in range(30))
    own = cont.Benchmark(["0"], cont.words_of(*flat([item])))
    symbols = np.searchsorted(own.vocabulary, cont.words_of(*flat([text])).hashes)
    length, *_ = cont.longest_matches(own, symbols)
    t, q = text.split(), item.split()
    for k in range(len(q)):
        best = max(next((d for d in range(len(q) - k) if i + d >= len(t) or t[i + d] != q[k + d]), len(q) - k) for i in range(len(t)))
        assert length[k] == best


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))


def test_nothing_to_compare(spark):
    docs = frame(spark, corner_rows())
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert cont.contamination(docs, none).where("contaminated or n_hit > 0").count() == 0
    assert cont.contamination(frame(spark, []), benchmark(spark)).count() == 0


# -- secrets ---------------------------------------------------------------------

SECRET = 'password = "hunter2hunter2"'
KEY = "AKIA" + "ABCDEFGH12345678"


def spans_of(text):
    base, spans = secret_scan.find_secrets(text)
    return secret_scan.in_order(base), secret_scan.in_order(spans)


@pytest.mark.parametrize(
    "text",
    [
        "", SECRET, f"x {KEY} y", "AKIAABC AKIAAKIA" + "A" * 16, "deadbeef" * 3, "deadbeef" * 2, "Api_Key:'abcdef' APIKEY = \"1234567\"", "token=abc secret=token: abcdefgh",
        "passwd:abcdef password:abcdefg", "ſecret=abcdefgh toKen=abcdefgh", "é🙂 token = abcdefgh", "token\n=abcdef", "token= ' abcdef",
    ],
)
def test_base_rules(text):
    assert spans_of(text)[0] == base_spans(text)


def encoders():
    b64 = lambda b: base64.b64encode(b).decode()
    return {
        "base64": lambda s: b64(s.encode()),
        "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
        "url": lambda s: urllib.parse.quote(s, safe=""),
        "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        "hex escape": lambda s: "".join(f"\\x{ord(c):02X}" for c in s),
        "entity": lambda s: "".join(f"&#{ord(c)};" for c in s),
        "gzip": lambda s: b64(gzip.compress(s.encode())),
        "zlib": lambda s: b64(zlib.compress(s.encode())),
        "bz2": lambda s: b64(bz2.compress(s.encode())),
        "xz": lambda s: b64(lzma.compress(s.encode())),
        "zstd": lambda s: b64(zstandard.compress(s.encode())),
        "twice packed": lambda s: b64(zlib.compress(gzip.compress(s.encode()))),
    }


@pytest.mark.parametrize("outer", [None, *encoders()])
@pytest.mark.parametrize("inner", list(encoders()))
def test_layers(inner, outer):
    hidden = encoders()[inner](f"see {SECRET} and {KEY}.")
    if outer:
        hidden = encoders()[outer](hidden)
    text = f"Ünïcode before: {hidden} and after"
    base, spans = spans_of(text)
    found = {k for k, a, b in spans if a >= text.index(hidden) and b <= text.index(hidden) + len(hidden)}
    assert {"assign", "access"} <= found
    assert set(base) <= set(spans)


def test_spans_are_mapped_back():
    text = "x pass%77ord=hunter2x y"
    assert ("assign", 2, 21) in spans_of(text)[1]
    hidden = base64.b64encode(b"token=abcdefgh").decode()
    text = f"é {hidden} z"
    assert spans_of(text)[1] == [("assign", 2, 2 + len(hidden))]


@pytest.mark.parametrize("plain", ["password = hunter2x", 'api_key = "abcdefg"', "token  :  'abcdefgh", "secret= token= passwd = abcdef"])
@pytest.mark.parametrize("escape", ["%{:02X}", "\\u{:04x}", "\\x{:02x}", "&#{};"])
def test_partly_escaped_with_blanks(plain, escape):
    """One character escaped, whichever it is, in a longer text: found as in the whole text decoded."""
    for k, c in enumerate(plain):
        own = escape.format(ord(c))
        text = f"é one two {plain[:k]}{own}{plain[k + 1 :]} three four"
        back = lambda p, k=k + 10, n=len(own) - 1: p if p <= k else p + n
        expected = {(kind, back(a), back(b)) for kind, a, b in secret_scan.scan(f"é one two {plain} three four") if a <= k + 10 < b}
        assert expected <= set(spans_of(text)[1])
        assert set(spans_of(text)[1]) - expected <= set(spans_of(text)[0])


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize(
    "data",
    [
        f"café {SECRET} {KEY}".encode("latin-1"), f"é中 {SECRET} 中 {KEY}中".encode("utf-16-le"), f"中 {SECRET}中 {KEY}".encode("utf-16"), f"中 {SECRET}é中 {KEY}中".encode("utf-16-be"),
        bytes(range(256)) + f"{SECRET} {KEY}".encode() + bytes(range(255, -1, -1)), b"\x80\x01\x02" * 101 + f"{SECRET}\n{KEY}".encode("utf-16-le") + b"\xff" * 9,
        f'"password%20=%20hunter2x" \\x41{KEY[1:]}'.encode("utf-16-le"),
    ],
)
def test_layers_that_are_no_text(data, pack):
    """Latin-1, UTF-16 and binary: what is not fit to read is scanned as well."""
    hidden = base64.b64encode(pack(data)).decode()
    assert {("assign", 2, 2 + len(hidden)), ("access", 2, 2 + len(hidden))} <= set(spans_of(f"x {hidden} y")[1])


def test_clean_binary_has_no_spans():
    hidden = base64.b64encode(random.Random(7).randbytes(1 << 18)).decode()
    assert spans_of(f"x\t{hidden}") == ([], [])


def columns(s, n, end="\n"):
    return end.join(s[i : i + n] for i in range(0, len(s), n))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("n", [10, 64, 76])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_base64_over_lines(pack, n, end):
    """Whatever line the secret is on, also across a line end and on a short last line, with text on both sides."""
    r = random.Random(n)
    noise = "".join(r.choice("ghijklmnop .,;") for _ in range(3000))
    for before in (*range(40, 100, 7), 3000):
        hidden = columns(base64.b64encode(pack(f"{noise[:before]} {KEY}".encode())).decode(), n, end)
        text = f"see: {hidden}\nBest wishes"
        assert any(k == "access" and a >= 5 and b <= len(text) for k, a, b in spans_of(text)[1]), (before, text)


@pytest.mark.parametrize("front", ["dir/", "a/bc/d/", "x-", "x_y-z_", "name", "a", "ab", "abc", "-----BEGIN X-----\n"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_base64_behind_a_word(pack, front):
    hidden = base64.urlsafe_b64encode(pack(f"{SECRET} {KEY}".encode())).decode().rstrip("=")
    assert {"assign", "access"} <= {k for k, a, b in spans_of(f"at {front}{hidden}/e")[1]}


PACKS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]


@pytest.mark.parametrize("pack", PACKS)
def test_all_streams_are_read(pack, monkeypatch):
    """Secrets in the first, a later and the last stream, cut by an end of one, and in what is compressed again."""
    parts = [f"{KEY} and pass", 'word = "hunter2hunter2" ', "x" * 900, " " + "0123456789ab" * 2]
    whole = b"".join(pack(x.encode()) for x in parts)
    for data in (whole, b"\x00\xff" + whole + b"trailing", pack(whole), whole + b"\0" * 8 + whole):
        hidden = base64.b64encode(data).decode()
        assert spans_of(f"x {hidden}")[1] == [(kind, 2, 2 + len(hidden)) for kind in ("assign", "access", "hex")]
    # Too large together: told, and read nevertheless.
    monkeypatch.setattr(secret_scan, "DECODED_BYTES", 910)
    hidden = base64.b64encode(whole).decode()
    assert [k for k, _, _ in spans_of(f"x {hidden}")[1]] == ["assign", "access", "hex", "oversize"]


@pytest.mark.parametrize("write", [urllib.parse.quote_from_bytes, lambda b: repr(b)[2:-1], lambda b: "".join(f"\\x{c:02X}" for c in b), lambda b: "".join(f"&#{c};" for c in b)])
@pytest.mark.parametrize("pack", PACKS)
def test_compressed_behind_escapes(pack, write):
    hidden = write(pack(f"{SECRET} {KEY}".encode()))
    text = f"é 100%25 \\n {hidden} end"
    at = text.index(hidden)
    assert {("assign", at, at + len(hidden)), ("access", at, at + len(hidden))} <= set(spans_of(text)[1])


def test_clean_text_has_no_layers():
    r = random.Random(5)
    text = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 40))) for _ in range(3000))
    assert spans_of(text)[0] == spans_of(text)[1]


def test_cycles_and_bombs_end(monkeypatch):
    """A layer that decodes to what was seen at its place is not followed; a large layer is told, and scanned all the same."""
    assert spans_of("%2525252525")[1] == []
    monkeypatch.setattr(secret_scan, "DECODED_BYTES", 1000)
    bomb = base64.b64encode(zlib.compress(b"a" * 100_000)).decode()
    assert spans_of(f"x {bomb}")[1] == [("hex", 2, 2 + len(bomb)), ("oversize", 2, 2 + len(bomb))]


@pytest.mark.parametrize("name", ["zlib", "gzip", "bz2", "zstd"])
def test_large_layers_are_scanned_in_blocks(name, monkeypatch):
    """Secrets anywhere in a layer above the bound: at its begin and end, over every border, encoded once more inside."""
    monkeypatch.setattr(secret_scan, "DECODED_BYTES", 4000)
    r = random.Random(2)
    filler = lambda n: "".join(r.choice("ghij klm") for _ in range(n))
    pack = {"zlib": zlib.compress, "gzip": gzip.compress, "bz2": bz2.compress, "zstd": zstandard.ZstdCompressor().compress}[name]
    inner = base64.b64encode(KEY.encode()).decode()
    for at in (0, 2990, 3990, 4000, 7000, 19_000):
        text = filler(at) + " " + SECRET + " " + filler(20_000 - at)
        body = base64.b64encode(pack(text.encode())).decode()
        assert [k for k, _, _ in spans_of(f"x {body} y")[1]] == ["assign", "oversize"], at
    body = base64.b64encode(pack((filler(9000) + f" {inner} " + filler(9000)).encode())).decode()
    assert spans_of(f"x {body} y")[1] == [("access", 2, 2 + len(body)), ("oversize", 2, 2 + len(body))]
    # Streams that follow each other, together beyond the bound.
    body = base64.b64encode(b"".join(pack((filler(2500) + SECRET[:9] * (k == 3)).encode()) for k in range(4)) + pack((SECRET[9:] + " z").encode())).decode()
    assert [k for k, _, _ in spans_of(body)[1]] == ["assign", "oversize"]


def test_secret_spans(spark):
    rows = corner_rows() + [(50, f"a {SECRET}"), (51, encoders()["gzip"](SECRET)), (52, KEY), (52, KEY)]
    found = secret_scan.secret_spans(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], [tuple(s) for s in r["base"]]) for r in found), key=repr) == sorted(((r[0], base_spans(r[1])) for r in rows), key=repr)
    assert [tuple(s) for s in next(r for r in found if r["doc_id"] == 51)["spans"]][0][0] == "assign"
    assert secret_scan.secret_spans(frame(spark, [])).count() == 0
