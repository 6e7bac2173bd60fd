"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from medalcast.llm import textvec as tv
from medalcast.llm import toxicity

SPACE = " \t\n\x0b\x0c\r"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingle_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def classes(docs, num=85, den=100):
    """id -> (set size, smallest id reachable); docs: (id, text)."""
    sets = {i: shingle_set(t) for i, t in docs}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1:] if len(a) < len(b) else a[p + 1:] == b[p + 1:]


def removed_lines(docs, min_chars=24, max_edits=1):
    """{(id, line number)} to remove; docs: (id, text)."""
    seen, gone = {}, set()
    for i, t in sorted(docs, key=lambda r: r[0]):
        for n, x in enumerate((t or "").split("\n")):
            x = x.strip(SPACE)
            if not x:
                continue
            if x in seen:
                gone.add((i, n))
                continue
            if max_edits and len(x) >= min_chars and any(one_edit(x, y) for y in seen if len(y) >= min_chars - 1):
                gone.add((i, n))
            seen[x] = (i, n)
    return gone


def removed_pieces(docs, run_words, run_pieces, longest=12, reach=4):
    """id -> (pieces, removed pieces, removed words, text left); docs: (id, text), ids distinct."""
    def word_hash(w):                                     # the operator's hash of a word: it alone orders content cuts
        raw = w.encode()
        return int(tv.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tv.SPACED)[2][0])

    def split(text):
        """[(first character, words)] of every piece."""
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        h = [word_hash(m[0]) for m in found]
        ends = [i for i, m in enumerate(found)
                if i + 1 == len(found) or m[0][-1] in ".!?,;:" or "\n" in text[m.end():found[i + 1].start()]]
        for size, near in ((longest, reach), (2 * longest, 1)):
            more, lo = [], 0
            for z in ends:
                if z + 1 - lo > size:
                    more += [i for i in range(lo + near, z + 1 - near) if h[i] == min(h[i - near:i + near + 1])]
                lo = z + 1
            ends = sorted({*ends, *more})
        out, lo = [], 0
        for z in ends:
            out.append((found[lo].start(), [lower(m[0]) for m in found[lo:z + 1]]))
            lo = z + 1
        return out

    def spans(pieces):
        size = [len(w) for _, w in pieces]
        out = set()
        for b in range(len(pieces)):
            e = next((e for e in range(b + run_pieces, len(pieces) + 1) if sum(size[b:e]) >= run_words), None)
            if e:
                out.add((b, e))
            a = next((a for a in range(b + 1 - run_pieces, -1, -1) if sum(size[a:b + 1]) >= run_words), None)
            if a is not None:
                out.add((a, b + 1))
        return sorted(out)

    def text_of(pieces, lo, hi):
        return tuple(w for _, words in pieces[lo:hi] for w in words)

    cut, first = {i: split(t or "") for i, t in docs}, {}
    for i in sorted(cut):
        for lo, hi in spans(cut[i]):
            first.setdefault(text_of(cut[i], lo, hi), (i, lo, hi))
    result = {}
    for i, t in docs:
        gone = set()
        for lo, hi in spans(cut[i]):
            j, a, z = first[text_of(cut[i], lo, hi)]
            if (j, a, z) != (i, lo, hi):
                gone |= set(range(max(lo, z) if i == j else lo, hi))
        begin = [a for a, _ in cut[i]] + [len(t or "")]
        left = (t or "")[:begin[0]] + "".join(t[begin[n]:begin[n + 1]] for n in range(len(cut[i])) if n not in gone)
        result[i] = (len(cut[i]), len(gone), sum(len(cut[i][n][1]) for n in gone), t and left)
    return result


def toxic_sentences(text, longest=40):
    """[[features of each word]] of every sentence; a word's features are the operator's hashes of it and its stems."""
    out = []
    for part in re.split(r"[.!?\n]", text or ""):
        w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", part)
        for a in range(0, len(w), longest):
            out.append([])
            for x in w[a:a + longest]:
                raw = x.encode()
                feats = toxicity.sentences(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
                out[-1].append([int(f) for f in feats[0] if f])
    return out


def leaning_features(docs, labels, least):
    """Features whose share of toxic documents is ``least`` standard errors or more above the usual."""
    n, k = Counter(), Counter()
    known = [(i, t) for i, t in docs if i in labels]
    for i, t in known:
        for f in {f for s in toxic_sentences(t) for w in s for f in w}:
            n[f] += 1
            k[f] += labels[i]
    share = sum(labels[i] for i, _ in known) / len(known)
    return {f for f in n if (k[f] - n[f] * share) / math.sqrt(n[f] * share * (1 - share) + 1) >= least}


def toxic_scores(docs, weights, bias):
    """id -> noisy-or over sentences of the logistic of their features' weights."""
    out = {}
    for i, t in docs:
        clean = 1.0
        for s in toxic_sentences(t):
            clean *= 1 - 1 / (1 + math.exp(-(bias + sum(weights.get(f, 0.0) for w in s for f in w))))
        out[i] = 1 - clean
    return out


def overlaps(docs, items, n=13):
    """id -> (words, hit words, sorted item ids)."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - n + 1)) if w else ():
            windows[tuple(w[a:a + n])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, got = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                found = windows.get(tuple(w[a:a + size]))
                if found:
                    hit.update(range(a, a + size))
                    got |= found
        out[i] = (len(w), len(hit), sorted(got))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    count, cover = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if count[w[i], w[i + 1], w[i + 2]] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def conversation(turns):
    """n_turns, turns digest, loss chars, loss digest of (role, text) turns in order."""
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def first_records(pages, min_bytes=0):
    """[(id, bytes, base32 SHA-1, type, response's id)] of (id, html) pages, sorted."""
    import base64
    rows = [(i, (t or "").encode()) for i, t in pages]
    first = {}
    for i, p in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(p, [i, False])
    out = []
    for i, p in rows:
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        held = first[p]
        if len(p) < min_bytes or (held[0] == i and not held[1]):
            held[1] = held[1] or len(p) >= min_bytes
            out.append((i, len(p), sha, "response", None))
        else:
            out.append((i, len(p), sha, "revisit", held[0]))
    return out


def damaged(rows):
    """Rows (conv, turn, role, text) after damage, per conversation in order; every conversation is a key."""
    import zlib
    out = defaultdict(list)
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        here = out[c]
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        if kind:
            here += [(t, r, x)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2])) for c, v in out.items()}


def cheapest(rows):
    """(cost, edits) by working backwards over (row, last role); rows: (must go, truncated, initial)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    added = {"": "u", "s": "u", "u": "a", "a": "u"}
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        here = {}
        for last in follows:
            ways = [(0, "")] if i == n and last in ("", "a") else []
            if i < n:
                go, cut, x = rows[i]
                c, e = best[i + 1, last]
                ways.append((c + 3, "D" + e))
                if not go:
                    if x and x in follows[last]:
                        c, e = best[i + 1, x]
                        ways.append((c + cut, "K" + e))
                    c, e = best[i + 1, added[last]]
                    ways.append((c + 2 + cut, "R" + e))
            here[last] = ways
        for last in follows:                 # up to three insertions in a row
            ways, at, ins = list(here[last]), last, 0
            while ins < 3:
                at, ins = added[at], ins + 1
                ways += [(c + 2 * ins, "I" * ins + e) for c, e in here[at]]
            best[i, last] = min(ways)
    return best[0, ""]


def repairs(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, edits, digest) of (conv, turn, role, text) rows as they are, in order."""
    out = {}
    for conv, turns in rows.items():
        seen, marks, count = set(), [], Counter()
        for _, r, x in turns:
            body = x.rstrip(SPACE)
            fault = "blank" if not body else "dup" if (r, x) in seen else "cut" if body[-1] not in ".!?" else ""
            seen.add((r, x))
            count[fault] += 1
            marks.append((fault in ("blank", "dup"), int(fault == "cut"), r[:1]))
        cost, edits = cheapest(marks)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        said, last, at = [], "", 0
        for e in edits:
            if e == "I":
                last = "a" if last == "u" else "u"
                said.append(("user:" if last == "u" else "assistant:"))
                continue
            _, r, x = turns[at]
            at += 1
            if e == "K":
                last = r[:1]
                said.append(f"{r}:{x}")
            elif e == "R":
                last = "a" if last == "u" else "u"
                said.append(("user:" if last == "u" else "assistant:") + x)
        out[conv] = (gaps, count["blank"], count["dup"], count["cut"], illegal, cost, edits, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def alignments(docs, encode_a, encode_b):
    """id -> (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of unique ids; encoders give (id, bytes) lists for a whole text."""
    out, links = {}, {}
    for i, t in docs:
        a, b = (encode_a(t), encode_b(t)) if t else ([], [])
        want = (" " + t).encode() if t else b""
        if not t or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            out[i], links[i] = (0, 0, 0, ""), []
            continue

        def ranges(toks):
            at, got = 0, []
            for k, x in toks:
                got.append((at, at + len(x), k))
                at += len(x)
            return got
        ra, rb = ranges(a), ranges(b)
        cuts, groups, start = sorted({x[1] for x in ra} & {x[1] for x in rb}), [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(k) for s, _, k in side if start <= s < c) for side in (ra, rb)))
            start = c
        links[i] = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]]
        out[i] = (len(ra), len(rb), len(cuts), ";".join(groups))
    count = Counter(p for got in links.values() for p in set(got))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return {i: (v[0], v[1], v[2], len(links[i]), sum(count[p] == best[p[0]] for p in links[i]), sum(count[p] for p in links[i]), v[3]) for i, v in out.items()}


def url_verdicts(pages, rules, lift=2.0, damping=0.85, rounds=300):
    """[(host, path, rule, verdict)] of (url, html) pages, by plain loops."""
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def cut(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        return low(host), re.match(r"[^?#]*", rest[len(host):])[0]
    rows, pages_of, links = [], Counter(), Counter()
    for url, html in pages:
        host, path = cut(url)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, ruled = max(fits) if fits else (0, None, None)
        rows.append((host, path, rule, ruled))
        if host:
            pages_of[host, ruled] += 1
            for dst in {cut(x)[0] for x in re.findall(r"(?i)href\s*=\s*[\"']?([a-z][a-z0-9+.-]*://[^\"'\s>]*)", html or "")}:
                if dst and dst != host:
                    links[host, dst] += 1
    hosts = {h for h, _ in pages_of}
    for h in hosts:
        up = h.split(".", 1)[1] if h.count(".") >= 2 else ""
        if up in hosts:
            links[h, up] += 1
            links[up, h] += 1

    def rank(seed, edges):
        total = sum(seed.values())
        if not total:
            return {}
        seed = {h: w / total for h, w in seed.items()}
        out = Counter()
        for (a, _), w in edges.items():
            out[a] += w
        r = dict(seed)
        for _ in range(rounds):
            nxt = {h: (1 - damping) * w for h, w in seed.items()}
            for (a, b), w in edges.items():
                nxt[b] = nxt.get(b, 0) + damping * r.get(a, 0) * w / out[a]
            r = nxt
        return {h: x * total for h, x in r.items()}
    back = Counter({(b, a): w for (a, b), w in links.items()})

    def seeds(kind):
        got = Counter()
        for (h, v), n in pages_of.items():
            if kind in (None, v):
                got[h] += n
        return got
    ranks = {"trust": (rank(seeds("allow"), links), rank(seeds(None), links)), "distrust": (rank(seeds("block"), back), rank(seeds(None), back))}
    is_open = {h for h, _, _, v in rows if h and v is None}
    usual, share = {}, {}
    for k, (some, whole) in ranks.items():
        base = sum(whole.get(h, 0) for h in is_open)
        usual[k] = sum(some.get(h, 0) for h in is_open) / base if base else 0
        share[k] = {h: some.get(h, 0) / x for h, x in whole.items() if x}
    out = []
    for host, path, rule, ruled in rows:
        t, d = share["trust"].get(host, 0), share["distrust"].get(host, 0)
        worse = usual["distrust"] * t < usual["trust"] * d if usual["trust"] else d > 0
        out.append((host, path, rule, ruled or ("block" if d > lift * usual["distrust"] and worse else "allow")))
    return out
