"""Plain, slow versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1(docs, items):
    windows = []
    for item_id, text in items:
        w = WORD.findall(lower(text))
        if w:
            windows += [(item_id, w[i:i + 13]) for i in range(max(1, len(w) - 12))]
    out = []
    for doc_id, text in docs:
        w, hit, held = WORD.findall(lower(text)), set(), set()
        for item_id, x in windows:
            for s in range(len(w) - len(x) + 1):
                if w[s:s + len(x)] == x:
                    hit.update(range(s, s + len(x)))
                    held.add(item_id)
        ids = ",".join(sorted(str(i) for i in held if i is not None))
        out.append((doc_id, len(w), len(hit), len([i for i in held if i is not None]), sha(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def op2(docs):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and doc_id is not None:
                held[key(line)].add(doc_id)
    keeper = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def fingerprint(text):
    w = TOKEN.findall(lower(text))
    if not w:
        return 0
    runs = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def op8(docs):
    fps = [fingerprint(t) for _, t in docs]
    group = components(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    first = {}
    for g, (doc_id, _) in zip(group, docs):
        ids = [x for x in (first.get(g), doc_id) if x is not None]
        first[g] = min(ids) if ids else None
    return [(doc_id, f"{fp:016x}", first[g]) for (doc_id, _), fp, g in zip(docs, fps, group)]


def _spans(text, kinds):
    found = []
    for order, (kind, pattern, ok) in enumerate(kinds):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if ok(m)]
    return sorted(found)


def _listed(found):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)


SECRET_KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


PII_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
]


def base_spans(docs, kinds):
    """doc_id, a count for each kind, base_sha256 and the base list itself."""
    out = []
    for doc_id, text in docs:
        found = _spans(text or "", kinds)
        n = Counter(k for *_, k in found)
        out.append((doc_id, *(n[k] for k, *_ in kinds), sha(_listed(found)), _listed(found)))
    return out


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def op9(docs):
    out = []
    for doc_id, text in docs:
        w, places, labels = WORD.findall(lower(text)), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            for s in range(len(w) - len(p) + 1):
                if w[s:s + len(p)] == p:
                    places.append(s)
                    labels.add(label)
        out.append((doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return out


def op10_base(docs):
    def train(doc_id):
        return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2

    counts = Counter()
    for doc_id, text in docs:
        if train(doc_id):
            counts.update([*TOKEN.findall(lower(text)), "\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in docs:
        t = [*TOKEN.findall(lower(text)), "\n"]
        out.append((doc_id, not train(doc_id), len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)))
    return out


def op10_score(docs, prior):
    """log10 probabilities of the word-pair model, from plain dictionaries."""
    def train(doc_id):
        return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2

    rows = [["<s>", *TOKEN.findall(lower(text)), "\n"] for _, text in docs]
    words, pairs, after = Counter(), Counter(), Counter()
    for (doc_id, _), t in zip(docs, rows):
        if train(doc_id):
            words.update(t[1:])
            pairs.update(zip(t, t[1:]))
            after.update(t[:-1])
    n, v = sum(words.values()), len(words)
    return [sum(math.log10((pairs[a, b] + prior * (words[b] + 1) / (n + v + 1)) / (after[a] + prior)) for a, b in zip(t, t[1:])) for t in rows]


def op11(docs, path, end_id=1):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, signed_xxh64(r[1] or ""))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def signed_xxh64(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def op12(docs, items, percent=10, least=20, buckets=10_000, run=1):
    def found(text):
        words = WORD.findall(lower(text))
        runs = [" ".join(words[i:i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
        return words, [zlib.crc32(f.encode()) % buckets for f in runs]

    own, target = Counter(), Counter()
    for _, text in docs:
        own.update(found(text)[1])
    for _, text in items:
        target.update(found(text)[1])
    s, t = sum(own.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in own}
    rows = []
    for doc_id, text in docs:
        words, fs = found(text)
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        h = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(fs), weight, score, len(words) >= least, signed_xxh64(text or "")))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    drawn = fit[:percent * len(fit) // 100]
    ranks = defaultdict(list)
    for rank, r in enumerate(drawn, 1):
        ranks[r].append(rank)
    return [(*r[:4], ranks[r].pop() if ranks[r] else None) for r in rows]


def cheapest(symbols):
    """Least cost and, of equals, least letters, from the end of a conversation to its start."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(best):
        out = dict(best)
        for _ in range(3):
            for state in range(4):
                cost, letters = out[after[state]]
                out[state] = min(out[state], (cost + 3, "I" + letters))
        return out

    never = (10**9, "")
    best = with_inserts({0: (0, ""), 1: never, 2: never, 3: (0, "")})
    for initial, must_go, cut in reversed(symbols):
        new = {}
        for state in range(4):
            ways = [(4 + best[state][0], "D" + best[state][1])]
            if not must_go:
                due = after[state]
                ways.append((3 + 3 * cut + best[due][0], "R" + best[due][1]))
                to = 1 if initial == "s" and state == 0 else due if initial == {2: "u", 3: "a"}[due] else None
                if to is not None:
                    ways.append((3 * cut + best[to][0], "K" + best[to][1]))
            new[state] = min(ways)
        best = with_inserts(new)
    return best[0]


def op13_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def op13(rows, damage=True):
    held = defaultdict(list)
    for conv in {r[0] for r in rows}:
        held[conv] = []
    for conv, turn, role, text in op13_damage(rows) if damage else rows:
        held[conv].append((turn, role, text))
    out = []
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(f"{len(r[1])}:{r[1]}{r[2]}")))
        seen, symbols, counts = set(), [], Counter()
        for _, role, text in own:
            last = TOKEN.findall(text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0][-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = cheapest(symbols)
        left, last, todo = [], "", iter(own)
        for letter in audit:
            _, role, text = next(todo) if letter != "I" else (0, "", "")
            if letter in "IR":
                role = "assistant" if last == "u" else "user"
            if letter != "D":
                left.append(f"{role}:{text}")
                last = role[:1]
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(left))))
    return out
