"""Plain Python versions of the operators, on lists of (doc_id, text)."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\r\x0b\x0c"


def in_order(docs):
    return sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))


def sha256(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def token_output(docs, tokenizer, end=1):
    import numpy as np

    out, start = [], 0
    for doc_id, text in in_order(docs):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def edited(docs):
    rows = in_order(docs)
    out = []
    for j, (doc_id, text) in enumerate(rows):
        half = len(text) // 2
        changed = text[: len(text) - half] + rows[(j + 1) % len(rows)][1][:half]
        out.append((doc_id, len(text), sha256(changed)))
    return out


def warc(pages):
    first = {}
    for page_id, html in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", page_id)
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        refers = first.get(html or "")
        again = page_id is not None and refers != page_id
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), name, "revisit" if again else "response", refers if again else None))
    return out


def repeated_bytes(docs, length=100):
    seen, out = set(), []
    for doc_id, text in in_order(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((doc_id, len(data), sum(gone), spans, sha256(kept)))
    return out


def line_key(line):
    return line.strip(SPACE).translate(FOLD)


def line_dedup(docs, least_points=40, least_docs=5):
    low = -(1 << 63)
    owners = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= least_points:
                owners[line_key(line)].add(low if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        me = low if doc_id is None else doc_id
        kept = [x for x in lines if len(owners[line_key(x)]) < least_docs or max(owners[line_key(x)]) == me]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha256("\n".join(kept))))
    return out


def shingles(text, k):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near_dedup(docs, k, percent):
    """{doc_id: (number of shingles, component)}, all pairs compared."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def contaminated(docs, items, window=15, agree=12):
    """Pairs with a window of ``window`` words of which ``agree`` agree, at any shift."""
    words = {j: WORD.findall((t or "").translate(FOLD)) for j, t in items}
    out = set()
    for doc_id, text in docs:
        mine = WORD.findall((text or "").translate(FOLD))
        for item, other in words.items():
            size = min(window, len(other))
            if size < 6:
                continue
            least = size if size < 9 else -(-size * agree // window)
            if any(
                sum(x == y for x, y in zip(mine[a : a + size], other[b : b + size])) >= least
                for a in range(len(mine) - size + 1)
                for b in range(len(other) - size + 1)
                if mine[a] == other[b] or mine[a + 1] == other[b + 1] or mine[a + 2] == other[b + 2] or mine[a + 3] == other[b + 3]
            ):
                out.add((doc_id, item))
    return out


KINDS = (
    ("assign", re.compile(r"""(?:%s)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")
    )), 1, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def base_secrets(text):
    spans, counts = [], [0, 0, 0]
    for rank, (_, pattern, group, least) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                spans.append((m.start(), rank, m.end()))
                counts[rank] += 1
    return counts, ",".join(f"{KINDS[r][0]}:{a}:{b}" for a, r, b in sorted(spans))


def mixture(docs, leaf_of, weights, levels, share, seed, max_epochs):
    """{doc_id: epochs} by recursive dealing; docs are (doc_id, text, row)."""
    tokens = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    leaves = defaultdict(list)
    for i, _, row in docs:
        leaves[leaf_of(row)].append(i)
    size = {leaf: sum(tokens[i] for i in ids) for leaf, ids in leaves.items()}
    budget = int(sum(size.values()) * share)
    given = {}

    def weight_of(path):
        escaped = [x.replace("\\", "\\\\").replace("/", "\\/") for x in path]
        return max(weights.get((levels[len(path) - 1], "/".join(escaped)), 1.0), 0.0)

    def capacity(path):
        """Tokens that the leaves below can take: none below a node without weight."""
        if len(path) == len(levels):
            return size[path]
        return sum(capacity(c) for c in {leaf[: len(path) + 1] for leaf in size if leaf[: len(path)] == path} if weight_of(c) > 0)

    def deal(path, amount):
        depth = len(path)
        if depth == len(levels):
            given[path] = amount
            return
        children = sorted({leaf[: depth + 1] for leaf in size if leaf[:depth] == path})
        weight = {c: weight_of(c) for c in children}
        room = {c: max_epochs * capacity(c) for c in children}
        out, open_, left = dict.fromkeys(children, 0), [c for c in children if weight[c] > 0], amount
        while open_:
            total = sum(weight[c] for c in open_)
            full = [c for c in open_ if room[c] * total <= left * weight[c]]
            if not full:
                for c in open_:
                    out[c] = min(int(left * weight[c] / total), room[c])
                break
            for c in full:
                out[c] = room[c]
            left -= sum(room[c] for c in full)
            open_ = [c for c in open_ if c not in full]
        for c in children:
            deal(c, out[c])

    deal((), budget)
    taken = {}
    for leaf, ids in leaves.items():
        epochs, rest = divmod(given[leaf], size[leaf]) if size[leaf] else (0, 0)
        key = {i: hashlib.md5(f"{seed}:{epochs}:{'' if i is None else i}".encode()).hexdigest()[:16] for i in ids}
        sums = defaultdict(int)
        for i in ids:
            sums[key[i]] += tokens[i]
        fit, total, stopped = set(), 0, False
        for k in sorted(sums):
            total += sums[k]
            stopped = stopped or total > rest
            if not stopped:
                fit.add(k)
        for i in ids:
            n = epochs + (rest > 0 and key[i] in fit)
            if n:
                taken[i] = n
    return taken


LOWER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_list(text):
    found = LOWER_WORD.findall((text or "").translate(FOLD))
    return found, [" ".join(found[i : i + j]) for i in range(len(found)) for j in (1, 2, 3) if i + j <= len(found)]


def resample(docs, target, percent=5, least=20, seed=42):
    import math

    def totals(texts):
        out = [0] * 10000
        for text in texts:
            for f in feature_list(text)[1]:
                out[zlib.crc32(f.encode()) % 10000] += 1
        return out

    s, t = totals(x for _, x in docs), totals(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        found, features = feature_list(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in features)
        h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}")[:8], 16)
        rows.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(found)])
    eligible = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2]))
    for i, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def conversations(rows):
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Paths are searched by cost, then by audit."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        spaced = lambda x: " " if x is None else x
        fault = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        if fault:
            groups[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return [(conv, *repaired(turns)) for conv, turns in groups.items()]


def repaired(turns):
    import heapq

    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
    faults, seen = [], set()
    for _, role, text in turns:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = zip(turns[:-1], turns[1:])
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in pairs)
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
            return gaps, *counts, illegal, cost, audit, sha256("\n".join(out))
        if (at, state) in done:
            continue
        done.add((at, state))
        for role in ("user", "assistant"):
            if role[0] in follow[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, role[0], (*out, f"{role}:")))
        if at < len(turns):
            _, role, text = turns[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, out))
            if faults[at] not in ("blank", "duplicate"):
                more = 5 if faults[at] else 0
                if role[:1] in follow[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in follow[state]:
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, new[0], (*out, f"{new}:{text}")))


def language_model(rows):
    """{lang: {bucket: n}} and rows per language of (text, lang), by character n-grams of one to three in plain integers."""
    counts, sizes = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for text, lang in rows:
        sizes[lang] += 1
        for b in ngram_buckets(text):
            counts[lang][b] += 1
    return counts, sizes


def ngram_buckets(text):
    mask = (1 << 64) - 1
    points = [c if c.isalpha() else " " for c in f" {text.lower()} "]
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            gram = points[i : i + n]
            if any(c != " " for c in gram):
                code = n
                for c in gram:
                    code = (code * 0x9E3779B97F4A7C15 + ord(c)) & mask
                code = ((code ^ code >> 30) * 0xBF58476D1CE4E5B9) & mask
                code = ((code ^ code >> 27) * 0x94D049BB133111EB) & mask
                yield (code ^ code >> 31) % 32768


def language(model, text):
    """Language and posterior."""
    import math

    counts, sizes = model
    if not any(c.isalpha() for c in (text or "").lower()):
        return "und", 0.0
    sums = {}
    for lang in sorted(sizes):
        total = sum(counts[lang].values()) + 0.5 * 32768
        sums[lang] = math.log(sizes[lang] / sum(sizes.values())) + sum(math.log((counts[lang][b] + 0.5) / total) for b in ngram_buckets(text))
    best = max(sums, key=sums.get)
    return best, 1 / sum(math.exp(x - sums[best]) for x in sums.values())
