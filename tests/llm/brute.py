"""Plain versions of the operators' contracts, for small tables."""

import functools
import hashlib
import itertools
import re
import zlib

import numpy as np
from xxhash import xxh64_intdigest

BLANKS = re.compile("[\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    norm = {k: BLANKS.sub(" ", t or "") for k, (_, t) in enumerate(rows)}
    groups = {}
    for k, n in norm.items():
        groups.setdefault(n, []).append(rows[k][0])
    least = {n: min((i for i in ids if i is not None), default=None) for n, ids in groups.items()}
    return sorted(((i, least[norm[k]], len(groups[norm[k]]), i == least[norm[k]], sha(norm[k])) for k, (i, _) in enumerate(rows)), key=repr)


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = {}
    for k, fp in enumerate(fps):
        distinct.setdefault(fp, []).append(k)
    for ks in distinct.values():
        for k in ks[1:]:
            root[find(k)] = find(ks[0])
    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(distinct[a][0])] = find(distinct[b][0])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def leaks(rows, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def words(t):
        return word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (items := windows.get(tuple(w[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= items
        listed = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(listed), sha(",".join(listed)), bool(hit)))
    return sorted(out, key=repr)


def bpe(rows, path):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(path), []
    tokenizer.no_truncation()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def token_files(rows, path):
    import struct

    from tokenizers import Tokenizer

    tokenizer, out, start = Tokenizer.from_file(path), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return sorted(out, key=repr)


def _listed(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secrets(rows):
    kinds, out = ("assign", "access", "hex"), []
    assign = re.compile(r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?:w|W)(?:d|D))|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, text in rows:
        t, spans = text or "", []
        spans += [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        out.append((i, *(sum(s[1] == k for s in spans) for k in range(3)), sha(_listed(spans, kinds))))
    return sorted(out, key=repr)


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(rows):
    kinds, out = ("email", "ip", "card", "phone"), []
    for i, text in rows:
        t, spans = text or "", []
        spans += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[^0-9]", "", m[0])
            spans += [(m.start(), 2, m.end())] if 14 <= len(d) <= 19 and _luhn(d) else []
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
            spans += [(m.start(), 3, m.end())] if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
        out.append((i, *(sum(s[1] == k for s in spans) for k in range(4)), sha(_listed(spans, kinds))))
    return sorted(out, key=repr)


def repeats(rows, size=50):
    least, data = {}, [((_i is None, _i or 0), _i, (t or "").encode()) for _i, t in rows]
    for order, _, d in data:
        for a in range(len(d) - size + 1):
            s = d[a : a + size]
            if s not in least or order < least[s]:
                least[s] = order
    out = []
    for order, i, d in data:
        gone = bytearray(len(d))
        for a in range(len(d) - size + 1):
            if least[d[a : a + size]] < order:
                gone[a : a + size] = b"\1" * size
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def runs(words):
    """(start, length, period) of every stretch of four periods and six words at least, by comparing at all distances."""
    named, found = np.array([*map({w: k for k, w in enumerate(dict.fromkeys(words))}.get, words)]), []
    for q in range(1, len(words) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], named[:-q] == named[q:], [0])).astype(int)))
        for i, j in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            if j - i >= max(6, 4 * q) and not any(q % d == 0 and words[i : i + q] == words[i : i + d] * (q // d) for d in range(1, q)):
                found.append((i, j - i, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rows):
    out = []
    for i, text in rows:
        words, n = (text or "").encode().split(), len((text or "").encode().split())
        if i is not None and n:
            h = zlib.crc32(str(i).encode())
            if h % 10 == 0:
                a = h // 10 % n
                p = 1 + (n - a) // (3 + h // 10 % 8)
                words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = runs(words)
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        largest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(found), *largest, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@functools.cache
def ranks(path):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def byte_bpe(rows, path):
    library, out = ranks(path), []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    return sorted(out, key=repr)
