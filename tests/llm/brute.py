"""Plain Python forms of the operators, for small inputs: rows are dicts."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def blank_words(text):
    return BLANK.findall(text or "")


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):]).group()


def url_rule(url, rules):
    host, path = host_path(url)
    fits = [(len(h) + len(p), len(h), a, h + p) for a, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def removed(docs, n=13):
    """Kept words of each (order key, text)."""
    least = {}
    split = [(k, blank_words(t)) for k, t in docs]
    for k, w in split:
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            least[key] = min(least.get(key, k), k)
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if least[tuple(w[i:i + n])] < k:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contamination(text, items, n=13):
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        m = min(n, len(w))
        wins = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1 if m else 0):
            if tuple(words[i:i + m]) in wins:
                hit.update(range(i, i + m))
                if item is not None:
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids, key=str.encode)


def fingerprint(text, shingle=3):
    w = blank_words((text or "").translate(LOWER))
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints):
    """Root (smallest position) of each entry of a list of fingerprints linked at 2 bits or fewer."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    names = sorted(set(prints))
    at = defaultdict(list)
    for i, p in enumerate(prints):
        at[p].append(i)
    for i, a in enumerate(names):
        for b in names[:i + 1]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(at[a][0]), find(at[b][0])
                root[max(x, y)] = min(x, y)
        for j in at[a]:
            x, y = find(at[a][0]), find(j)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def luhn(digits):
    return sum((d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def base_spans(text):
    found = []
    for rank, (kind, (pattern, ok)) in enumerate(PII.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return [(k, a, z) for a, _, k, z in sorted(found)]


def quality(text):
    w = blank_words(text)
    wins = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {j for i in range(len(w) - 2) if wins[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if BLANK.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep))


def crc(text):
    return zlib.crc32((text or "").encode())


def centroids(vectors: dict, k: int = 16, rounds: int = 3) -> tuple[dict, list]:
    """The same by plain comparison of every vector with every centroid: {id: (cluster, distance)}, centroids."""
    names = sorted(vectors, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:k]
    centers = [list(vectors[i]) for i in names]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own: dict = {}
        for v in vectors.values():
            own.setdefault(best(v)[1], []).append(v)
        for n, vs in own.items():
            centers[n] = [sum(x) // len(vs) for x in zip(*vs)]
    return {i: best(v)[::-1] for i, v in vectors.items()}, centers


LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, least_docs, top):
    """Rows (lang, source, part, item, value, rank) by plain loops over every group and kept term."""
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in docs:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = LETTERS.findall((r["text"] or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least_docs)
        v, sources = len(kept), sorted(g[1] for g in groups if g[0] == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * v) for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q = shares(whole)
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def rising(ones, counts):
    """Isotonic regression by its min-max formula."""
    n = len(ones)
    mean = lambda a, b: sum(ones[a:b + 1]) / sum(counts[a:b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


NAMES = ("key", "token", "secret", "passw", "pwd", "auth", "credential", "bearer", "signature")
RUN_CHARS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _run(t, i, padded=True):
    """Where the run from ``i`` ends, with its padding."""
    j = i
    while j < len(t) and t[j] in RUN_CHARS:
        j += 1
    k = j
    while k < len(t) and t[k] == "=" and k - j < 2:
        k += 1
    return k if padded and k > j and not (k < len(t) and (t[k] in RUN_CHARS or t[k] in "=\"'`")) else j


def _skip(t, i, chars, most):
    j = i
    while j < len(t) and t[j] in chars and j - i < most:
        j += 1
    return j


def _after_sign(t, i):
    """Position behind an assignment sign at ``i``, blanks and a quote, or None."""
    if i >= len(t) or t[i] not in "=:":
        return None
    i = _skip(t, i + 1, ">", 1)
    i = _skip(t, i, " \t", 4)
    return _skip(t, i, "\"'`", 1)


def _any_end(t, i):
    j = i
    while j < len(t) and ord(t[j]) > 0x20 and t[j] not in "\"'`<>(){}[],;&":
        j += 1
    end = j
    while end > i:
        pad = 0
        while pad < 2 and end - pad - 1 > i and t[end - pad - 1] == "=":
            pad += 1
        if t[end - pad - 1] not in ".!?:=":
            return end
        end -= 1
    return None


def _named_value(t, i):
    """Start of the value behind a secret-like name at ``i``, trying the longest name first as the expression does."""
    for name in NAMES:
        if t[i:i + len(name)].lower() == name and t[i:i + len(name)].isascii():
            j = i + len(name)
            most = _skip(t, j, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-", 24)
            for k in range(most, j - 1, -1):
                for q in ((k + 1, k) if k < len(t) and t[k] in "\"'`" else (k,)):
                    for blank in range(_skip(t, q, " \t", 4), q - 1, -1):
                        if blank < len(t) and t[blank] in "=:":
                            s = _skip(t, blank + 1, ">", 1)
                            for at in range(_skip(t, s, " \t", 4), s - 1, -1):
                                for v in ((at + 1, at) if at < len(t) and t[at] in "\"'`" else (at,)):
                                    if _any_end(t, v):
                                        return v
                    for blank in range(_skip(t, q, " \t", 4), q, -1):
                        for v in ((blank + 1, blank) if blank < len(t) and t[blank] in "\"'`" else (blank,)):
                            if _any_end(t, v):
                                return v
    return None


def proposed(t):
    """(start, end) of every proposed secret of a text, by a scan from left to right."""
    out, i = [], 0
    t = t or ""
    while i < len(t):
        v = _named_value(t, i)
        if v is not None:
            out.append((v, _any_end(t, v)))
        elif (v := _after_sign(t, i)) is not None and v < len(t) and t[v] in RUN_CHARS:
            out.append((v, _run(t, v)))
        elif t[i] in RUN_CHARS and (i == 0 or t[i - 1] not in RUN_CHARS) and _run(t, i, padded=False) - i >= 16 \
                and re.match(r"[A-Za-z+/_\-]*[0-9]", t[i:]):
            j = _run(t, i, padded=False)
            while j < len(t) and t[j] == "." and _run(t, j + 1, padded=False) - j - 1 >= 8:
                j = _run(t, j + 1, padded=False)
            out.append((i, _run(t, j)))
        else:
            i += 1
            continue
        i = out[-1][1]
    return out


def weighed(counts, steps=200, prior=0.8, right=0.8):
    """Expectation-maximisation over vote patterns, one pattern and rule at a time."""
    counts = sorted(counts)
    if not counts:
        return 0.0, []
    k = len(counts[0][0])
    start = {1: (right, 1 - right), 0: (1 - right, right), -1: (0.5, 0.5)}
    like = [{v: start[v] for v in (1, 0, -1)} for _ in range(k)]
    share = prior
    for _ in range(steps):
        good_n = bad_n = 0.0
        seen = [{v: [0.0, 0.0] for v in (1, 0, -1)} for _ in range(k)]
        for votes, c in counts:
            g, b = math.log(share), math.log(1 - share)
            for r, v in enumerate(votes):
                g, b = g + math.log(like[r][v][0]), b + math.log(like[r][v][1])
            p = 1 / (1 + math.exp(min(700.0, max(-700.0, b - g))))
            good_n, bad_n = good_n + c * p, bad_n + c * (1 - p)
            for r, v in enumerate(votes):
                seen[r][v][0] += c * p
                seen[r][v][1] += c * (1 - p)
        share = min(0.999, max(0.001, good_n / (good_n + bad_n)))
        # one text of each vote beforehand keeps probabilities off zero
        like = [{v: ((s[v][0] + 1) / (good_n + 3), (s[v][1] + 1) / (bad_n + 3)) for v in s} for s in seen]
        # no rule is worse than chance: a vote that would speak against itself says nothing
        for w in like:
            for v, (g, b) in ((1, w[1]), (0, w[0])):
                if (g < b) == (v == 1):
                    w[v] = ((g + b) / 2, (g + b) / 2)
            w[-1] = (sum(w[-1]) / 2, sum(w[-1]) / 2)  # to abstain says nothing
    return math.log(share / (1 - share)), [{v: math.log(w[v][0] / w[v][1]) for v in w} for w in like]


_M = (1 << 64) - 1


def spark_hash(*values):
    """Spark's xxhash64 of whole numbers and texts, signed."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64(v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode(), h).intdigest()
    return h - (1 << 64) if h >> 63 else h


def row_numbers(rows):
    """{row: number} of distinct rows of whole numbers: by hash bucket, then first column, hash and all columns."""
    n = len(rows)
    buckets = max(1, n // max(1000, math.isqrt(n)))
    return {r: i for i, r in enumerate(sorted(rows, key=lambda r: (spark_hash(*r) % buckets, r[0], spark_hash(*r), r)))}


def word_hash(b):
    """The 64-bit hash of a word's bytes, with plain integers."""
    h = (sum((x + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, x in enumerate(b)) + len(b)) & _M
    h = ((h ^ (h >> 32)) * 0xFF51AFD7ED558CCD) & _M
    h = ((h ^ (h >> 29)) * 0xC4CEB9FE1A85EC53) & _M
    return h ^ (h >> 32)


def toxicity_bins(text, space):
    """Bins of a text's words and of their first 4, 5 and 6 bytes."""
    out = set()
    for w in ALNUM.findall((text or "").translate(LOWER)):
        b = w.encode()
        out.add(word_hash(b) % space)
        out |= {(word_hash(b[:n]) ^ (0x51ED27A3C0FFEE00 + n)) % space for n in (4, 5, 6) if len(b) >= n}
    return out


def quality_votes(text):
    """The votes of the eleven quality rules on a text."""
    import regex
    t = text or ""
    n, chars, symbols, dups, repeats = quality(t)
    letters, upper = len(regex.findall(r"\p{L}", t)), len(regex.findall(r"\p{Lu}", t))
    marks, runs = len(regex.findall(r"[!?.,;:#*$%&|<>~=]{2,}", t)), len(regex.findall(r"[#*$%&|<>]+", t))
    lone = sum(bool(regex.fullmatch(r"[#*$%&|<>~=!?.,;:]+", w)) for w in blank_words(t))
    lines = max(1, sum(bool(blank_words(x)) for x in t.split("\n")))
    words, chars, letters = max(1, n), max(1, chars), max(1, letters)
    pairs = [(n >= 50, n < 10), (3 * n <= chars <= 10 * n, chars < 2 * n or chars > 15 * n), (20 * symbols < words, 4 * symbols > words),
             (10 * dups <= lines, 10 * dups > 3 * lines), (5 * repeats <= words, 10 * repeats > 3 * words), (None, None),
             (100 * symbols < chars, 20 * symbols > chars), (20 * runs < words, 5 * runs > words), (50 * marks < words, 10 * marks > words),
             (50 * lone < words, 10 * lone > words), (10 * upper <= 2 * letters, 2 * upper > letters)]
    n_letters = len(regex.findall(r"\p{L}", t))
    pairs[5] = (10 * n_letters >= 8 * chars, 10 * n_letters < 6 * chars)
    return tuple(0 if bad else 1 if good else -1 for good, bad in pairs)
