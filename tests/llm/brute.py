"""Plain Python versions of the operators, row by row and pair by pair."""
from __future__ import annotations

import hashlib
import math
import re
import zlib

import public_tokenizers
import tiktoken
import xxhash

from fleetscope.llm.byte_bpe import VOCABULARY, read_ranks

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def tokenizer():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=read_ranks(public_tokenizers.path(VOCABULARY)))


def fingerprint(text) -> int:
    w = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: list[int], budget: int = 3) -> list[int]:
    """For each value the place of the first one that its links reach."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= budget:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(values))]


def hits(text, items: dict[str, str]):
    """(words, places hit, items) for one text."""
    w = WORD.findall((text or "").translate(LOWER))
    places, found = set(), set()
    for item, other in items.items():
        own = WORD.findall((other or "").translate(LOWER))
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for k in range(len(w) - n + 1):
                if w[k:k + n] == own[i:i + n]:
                    places |= set(range(k, k + n))
                    found.add(item)
    return len(w), places, found


PII = (("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
       ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
       ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")))


def _valid(kind: str, text: str) -> bool:
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        luhn = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and luhn % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def personal(text) -> list[tuple[int, int, int, str]]:
    """Base spans (start, number of kind, end, kind)."""
    return sorted((m.start(), n, m.end(), kind) for n, (kind, pattern) in enumerate(PII)
                  for m in pattern.finditer(text or "") if _valid(kind, m[0]))


def masked(text: str, spans) -> str:
    out, done = [], 0
    for start, _, end, kind in spans:
        if start >= done:
            out.append(f"{text[done:start]}<{kind.upper()}>")
        done = max(done, end)
    return "".join(out) + text[done:]


def measured(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    seen: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {p for places in seen.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def trie(turns) -> list[tuple]:
    """Nodes of the prefix trie of rebuilt conversations, from (conv_id, turn, role, text)."""
    convs: dict[int, list] = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + convs[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    kids: dict[tuple, int] = {}
    for v in members:
        if v:
            kids[v[:-1]] = kids.get(v[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for v, own in members.items():
        for d in range(len(v) + 1):
            leaves[v[:d]] += v not in kids
            saved[v[:d]] += (len(own) - 1) * (len(SPACED.findall(v[-1][1])) if v else 0)
    return [(own[0], len(v), members[v[:-1]][0] if v else None, len(own), kids.get(v, 0), leaves[v], saved[v],
             sha(",".join(map(str, ends.get(v, []))))) for v, own in members.items()]


def hard_negatives(rows, every: int = 100) -> list[tuple]:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, vector, label)."""
    kept = [(i, v, label) for i, v, label in rows if label is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    dims = max([1] + [len(v) for _, v, _ in kept])
    most = min(1 << 30, math.isqrt((1 << 59) // dims))
    quantised = [(i, [math.floor(max(-most, min(most, 256 * x))) for x in v] + [0] * (dims - len(v)),
                  (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in kept]
    out = []
    for n, (anchor, a, own) in enumerate(quantised):
        if anchor is None or anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0, label) for m, (i, b, label) in enumerate(quantised) if m != n)
        for p, none, i, label in [x for x in scored if x[3] == own][:5]:
            low = [x for x in scored if x[3] != own and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(anchor, None if none else i, rank, None if x[1] else x[2], -p, -x[0]) for rank, x in enumerate(low, 1)]
    return out


def shingle_set(text) -> frozenset:
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def linked_sets(sets, percent: int = 85) -> list[int]:
    """For each set the place of the first one that its links reach."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
    return [find(i) for i in range(len(sets))]
