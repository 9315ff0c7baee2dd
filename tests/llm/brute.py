"""The contracts by the plainest means, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns named like those the operators make or use.
CLASHES = ("key", "h", "keep_id", "kept", "shard", "slot", "size", "spans", "th", "turn", "n", "score", "lang_pred", "sequence_id", "offset")


def frame(spark, rows, clashes=True):
    """``(doc_id, text)`` or ``(doc_id, text, lang)`` rows as a table of documents, with columns that clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    ddl = _DDL
    if clashes:
        full = [(*r, *("x" for _ in CLASHES)) for r in full]
        ddl += "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame(full, ddl)


def corner_rows():
    """Nulls, empty and blank texts, copies, repeated rows, a repeated id with another text, a long text."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    words = [f"w{i * 7919 % 1009}" for i in range(3000)]
    return [
        (1, base),
        (2, base.replace(" ", "\n\t ")),
        (3, None),
        (4, ""),
        (5, " \n "),
        (None, base),
        (None, None),
        (6, base + " phi"),
        (7, " ".join(words) * 3),
        (8, " ".join(words) * 3),
        (9, "one two"),
        (9, "one two"),
        (9, "another text under the same id"),
        (10, "One  TWO"),
        (11, "Ünïcödé текст 文字 🙂 " * 40),
        (12, "12345 !!! ???"),
    ]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def exact_groups(rows):
    blanks = re.compile(r"[\x20\x09-\x0D]+")
    normal = [blanks.sub(" ", r[1] or "") for r in rows]
    groups = defaultdict(list)
    for i, t in enumerate(normal):
        groups[t].append(i)
    out = []
    for t, members in groups.items():
        ids = [rows[i][0] for i in members]
        keep = min((x for x in ids if x is not None), default=None)
        first = True
        for x in ids:
            kept = first and x == keep
            first = first and not kept
            out.append((x, keep, len(members), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def near_groups(rows):
    """``doc_id, n_shingles, component_id`` of each row."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for r in rows:
        w = word.findall((r[1] or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def contamination(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for n, (item, text) in enumerate(items):
        w = word.findall((text or "").translate(LOWER))
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add((str(item) if item is not None else "", n))
    out = []
    for doc_id, text, *_ in rows:
        w = word.findall((text or "").translate(LOWER))
        hit, found = [0] * len(w), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own:
                    found |= own
                    hit[i : i + size] = [1] * size
        names = ",".join(sorted(x for x, _ in found))
        n = sum(hit)
        out.append((doc_id, len(w), n, len(found), hashlib.sha256(names.encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return sorted(out, key=repr)


def without_repeats(rows, length):
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row."""
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc_id, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def token_ids(texts, vocabulary, end=0):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for t in texts]


def crc(ids) -> int:
    return zlib.crc32(ids.tobytes())


def base_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.A | re.I):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def fill_in_middle(rows):
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        name = "" if doc_id is None else str(doc_id)
        h = [int(hashlib.sha256(f"1:{name}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            out.append((doc_id, len(units), "plain", None, None, text))
        elif h[3] % 100 < 20:
            out.append((doc_id, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"))
        else:
            out.append((doc_id, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"))
    return sorted(out, key=repr)


def vector_codes(rows, parts=16, entries=64, rounds=2):
    """``vec_id, code, error`` of each kept ``(vec_id, vector, label)`` row, and the codebooks."""
    import math

    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        given = [[nearest(p, c[p])[1] for c in cut] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, given[p]) if g == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for (i, _, _), c in zip(kept, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(x for x, _ in best)))
    return sorted(out, key=repr), books
