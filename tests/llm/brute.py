"""What the text queries must return, by plain Python over all rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({c: c + 32 for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def first(doc_id):
    """NULL sorts first."""
    return (doc_id is not None, doc_id or 0)


def exact(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), first(doc_id), i, doc_id))
    out = Counter()
    for norm, members in groups.items():
        members.sort()
        for place, (_, _, _, doc_id) in enumerate(members):
            out[doc_id, members[0][3], len(members), place == 0, sha(norm)] += 1
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near(rows):
    """Rows are linked by their own texts; (doc_id, text) tells them apart."""
    sets = {row: shingles(row[1]) for row in rows if row[0] is not None}
    groups, keys = Union(), sorted((r for r in sets if sets[r]), key=lambda r: (r[0], r[1]))
    for k, a in enumerate(keys):
        for b in keys[:k]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    out = Counter()
    for row in rows:
        root = None if row[0] is None else groups.find(row)[0]
        out[row[0], len(shingles(row[1])), root, root == row[0]] += 1
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if _valid(kind, m[0]):
                found.append((m.start(), order, m.end(), kind))
    return sorted(found)


def personal(rows):
    out = Counter()
    for doc_id, text in rows:
        spans = base_spans(text)
        counts = Counter(kind for *_, kind in spans)
        told = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
        out[doc_id, *(counts[kind] for kind in BASE), sha(told)] += 1
    return out


_tokenizer = None


def token_ids(text):
    global _tokenizer
    _tokenizer = _tokenizer or Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return _tokenizer.encode(text or "", add_special_tokens=False).ids


def token_pieces(rows, size=4096):
    out = Counter()
    for doc_id, text in rows:
        ids = np.array([*token_ids(text), 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            out[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def contamination(rows, items):
    terms_of = lambda text: TERM.findall((text or "").translate(LOW))
    windows, pairs = defaultdict(set), defaultdict(set)
    texts = {(d, t): terms_of(t) for d, t in rows}
    seen = Counter(word for d, t in rows for word in texts[d, t])
    for item_id, text in items:
        words = terms_of(text)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            window = words[i : i + size]
            windows[tuple(window)].add(item_id)
            if all(seen[w] for w in window):
                rare = sorted((seen[w], w, k) for k, w in enumerate(window))
                pairs[item_id, tuple(words)].add((rare[0][1], rare[min(1, size - 1)][1], size == 1))
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in rows:
        words = texts[doc_id, text]
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    ids |= found
        names = sorted(str(i) for i in ids if i is not None)
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        places = defaultdict(list)
        for k, word in enumerate(words):
            places[word].append(k)
        near = sum(
            any(
                alone or any(p != q and abs(p - q) <= 13 for p in places[one] for q in places[two])
                for one, two, alone in rules
                if places[one] and places[two]
            )
            for rules in pairs.values()
        )
        out[doc_id, len(words), len(hit), len(names), sha(",".join(names)), bad, near] += 1
    return out


def repeats(rows):
    least = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = WORD.findall(text or "")
        for i in range(len(words) - 12):
            least.setdefault(tuple(words[i : i + 13]), doc_id)
    out = Counter()
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        covered = set()
        for i in range(len(words) - 12 if doc_id is not None else 0):
            if least[tuple(words[i : i + 13])] < doc_id:
                covered |= set(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in covered)
        out[doc_id, len(words), len(covered), sha(kept)] += 1
    return out


def lines(rows, ratio, least):
    """Rows are (doc_id, source, text)."""
    bare = lambda line: re.sub(r"[\t\x0b\f\r]", " ", line).strip(" ")
    pages, holds = Counter(), Counter()
    for _, source, text in rows:
        pages[source] += 1
        for line in {bare(x) for x in (text or "").split("\n")} - {""}:
            holds[source, line] += 1
    out = Counter()
    for doc_id, source, text in rows:
        all_ = [] if text is None else text.split("\n")
        kept = [
            x
            for x in all_
            if not bare(x) or holds[source, bare(x)] < least or holds[source, bare(x)] <= ratio * pages[source]
        ]
        out[doc_id, len(all_), len(all_) - len(kept), sha("\n".join(kept))] += 1
    return out


def edited(text, edits):
    parts, at = [], 0
    for start, end, new in sorted(edits):
        start, end = max(start, 0), min(end, len(text))
        if start < at or start > end:
            continue
        parts += [text[at:start], new]
        at = end
    return "".join(parts) + text[at:]


def resampled(rows, items):
    """(doc_id, n_features, weight, score, rank) of every row."""
    def features(text):
        words = TERM.findall((text or "").translate(LOW))
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]

    docs = [(doc_id, *features(text)) for doc_id, text in rows]
    corpus = Counter(b for *_, buckets in docs for b in buckets)
    target = Counter(b for _, text in items for b in features(text)[1])
    s_all, t_all = corpus.total() + 10000, target.total() + 10000
    gain = [
        math.floor(1000 * math.log((target[b] + 1) * s_all / ((corpus[b] + 1) * t_all))) for b in range(10000)
    ]
    scored = []
    for doc_id, n_words, buckets in docs:
        h = int(sha(f"42:{'' if doc_id is None else doc_id}")[:8], 16)
        weight = sum(gain[b] for b in buckets)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(buckets), weight, weight + noise, n_words >= 20))
    able = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = 5 * len(able) // 100
    out = Counter((*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able))
    return out + Counter((*r[:4], None) for r in scored if not r[4])


def base_scores(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens and base score of every row, in order."""
    def tokens(text):
        return [*WORD.findall((text or "").translate(LOW)), ""]

    out = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(t for (_, text), o in zip(rows, out, strict=True) if not o for t in tokens(text))
    bottom = counts.total() + 0.1 * (len(counts) + 1)
    found = []
    for (doc_id, text), o in zip(rows, out, strict=True):
        words = tokens(text)
        score = sum(math.log10((counts[t] + 0.1) / bottom) for t in words)
        found.append((doc_id, o, len(words), sum(counts[t] > 0 for t in words), counts.total(), score))
    return found


def code_length(text, tables):
    """Bits of a text by the mixing model, a bit at a time over plain lists."""
    from passbook.llm import mixing as m

    whole = bytes(m.LOOK_BACK) + text + bytes([m.END])
    bits = 0.0
    for start in range(m.LOOK_BACK, len(whole), m.SEGMENT):
        weights = defaultdict(lambda: [m.WEIGHT] * m.PREDICTORS)
        maps = {}
        for at in range(start, min(start + m.SEGMENT, len(whole))):
            symbol, back = whole[at], whole[at - m.LOOK_BACK : at]
            keys = []
            for order in m.ORDERS:
                keys.append(int.from_bytes(bytes([order]) + back[-order:], "big"))
            word = back[max((i + 1 for i, c in enumerate(back) if c in b"\0\t\n\v\f\r "), default=0) :]
            keys.append(sum((c + 1) * pow(m._BASE, i, 1 << 64) for i, c in enumerate(word)) + len(word))
            nibbles = [(0, m.FREQUENT.find(symbol))]
            if nibbles[0][1] < 0:
                nibbles = [(0, m.ESCAPE), (1, symbol >> 4), (2, symbol & 15)]
            for j, (kind, value) in [(j, nibble) for nibble in nibbles for j in range(4)]:
                votes, j = [], 4 * kind + j
                for k, key in enumerate(keys):
                    key = key * (m._BASE + 2 * k) % (1 << 64)
                    if kind > 0:
                        key = ((key ^ (key >> 29)) + 1) * m._SPREAD % (1 << 64)
                    if kind > 1:
                        key = ((key ^ (key >> 29)) + (symbol >> 4)) * m._SPREAD % (1 << 64)
                    tree = (key >> (64 - m.SLOT_BITS + 4)) << 4
                    votes.append(int(np.array([tables[k][tree + value]], np.uint32).view(np.int8)[j % 4]))
                gate, one = (j, sum(v != 0 for v in votes)), (value >> (3 - j % 4)) & 1
                x, w = [v / m.STEP for v in votes], weights[gate]
                mix = sum(a * b for a, b in zip(x, w, strict=True))
                p = 1 / (1 + math.exp(-mix))
                weights[gate] = [b + (one - p) * m.RATE * a for a, b in zip(x, w, strict=True)]
                cell = round(min(max(mix * 2, -16), 16))
                refined = maps.get((j, cell), 1 / (1 + math.exp(-cell / 2)))
                p = (p + refined) / 2
                maps[j, cell] = refined + (one - refined) * m.MAP_RATE
                p = (p if one else 1 - p) * (1 - 2 * m.LEAST) + m.LEAST
                bits -= math.log2(p)
    return bits


def ppm_bits(samples, text, order=3):
    """Bits of a text in each language of ``samples``, by counts in plain dicts."""
    out = {}
    for lang, texts in samples.items():
        counts = defaultdict(Counter)
        for one in texts:
            padded = bytes(order) + one
            for at in range(order, len(padded)):
                for n in range(order + 1):
                    counts[padded[at - n : at]][padded[at]] += 1
        bits, padded = 0.0, bytes(order) + text
        for at in range(order, len(padded)):
            for n in range(order, -1, -1):
                seen = counts.get(padded[at - n : at])
                if seen is None:
                    continue
                total, distinct = seen.total(), len(seen)
                if padded[at] in seen:
                    bits += math.log2((total + distinct) / seen[padded[at]])
                    break
                bits += math.log2((total + distinct) / distinct)
            else:
                bits += 8
        out[lang] = bits
    return out


def trie(rows):
    """The contract's rows for (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = sha(f"{len(role.encode())}:{role}{text}")
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [t[3:] for t in sorted(all_)] for c, all_ in own.items()}
    nodes = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        whole = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append((c, d == len(whole)))
    children = Counter(node[:-1] for node in nodes if node)
    leaves, saved = Counter(), Counter()
    for node, members in nodes.items():
        cost = (len(members) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += cost
    return Counter(
        (
            members[0][0],
            len(node),
            nodes[node[:-1]][0][0] if node else None,
            len(members),
            children[node],
            leaves[node],
            saved[node],
            sha(",".join(str(c) for c, ends in members if ends)),
        )
        for node, members in nodes.items()
    )
