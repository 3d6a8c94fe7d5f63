"""Brute-force versions of the contracts, in plain Python over lists of (doc_id, text)."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        out.append((doc, len(w), keep.count(False), sha(" ".join(x for x, k in zip(w, keep) if k))))
    return out


def groups(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(fold(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders.get(g, ()))
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                up[find(i)] = find(j)
        for g in s:
            holders.setdefault(g, []).append(i)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        least = min(known) if known else None
        out.append((doc, len(sets[i]), least, doc == least))
    return out


def contamination(rows, items):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(fold(text))
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).update([] if item is None else [str(item)])
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, ids = ALNUM.findall(fold(text)), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[i : i + m]))) is not None:
                    hit.update(range(i, i + m))
                    ids |= found
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


def entropy_spans(text, classes, allowed):
    out = []
    for k, c in enumerate(classes):
        for m in re.finditer(f"{c.pattern}{{{c.window},}}", text):
            s, mine = m[0], []
            if re.fullmatch("|".join(f"(?:{p})" for p in allowed), s):
                continue
            for i in range(len(s) - c.window + 1):
                bits = -sum(n / c.window * math.log2(n / c.window) for n in Counter(s[i : i + c.window]).values())
                if bits >= c.bits - 1e-9:
                    if mine and i <= mine[-1][1]:
                        mine[-1][1] = i + c.window
                    else:
                        mine.append([i, i + c.window])
            for a, b in mine:
                parts = re.split("example|0123456789|1234567890|abcdefghij|ABCDEFGHIJ", s[a:b])
                if "EXAMPLE" not in s[a:b] and max(map(len, parts)) >= c.window:
                    out.append((m.start() + a, 3 + k, m.start() + b))
    return out


def redacted(text, spans, mark="[SECRET]"):
    joined = []
    for start, end in sorted((s, e) for s, _, e in spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(end, joined[-1][1])
        else:
            joined.append([start, end])
    out, at = "", 0
    for start, end in joined:
        out, at = out + text[at:start] + mark, end
    return out + text[at:]


def base_quality(doc, text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return doc, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed


def likelihood_ratios(grams, target, buckets, smoothing):
    """Mean log ratio of target share to raw share over the bucketed n-grams of each document; None without any."""
    raw = Counter(g for x in grams for g in x)
    good = Counter(g for x, t in zip(grams, target) if t for g in x)
    n, m = sum(raw.values()), sum(good.values())

    def ratio(g):
        spread = smoothing * buckets
        return math.log((good[g] + smoothing) / (m + spread)) - math.log((raw[g] + smoothing) / (n + spread))

    return [sum(map(ratio, x)) / len(x) if x else None for x in grams]


def quantile(ordered, q):
    at = q * (len(ordered) - 1)
    low = ordered[math.floor(at)]
    return low + (at - math.floor(at)) * (ordered[math.ceil(at)] - low)


def best_cut(good, bad, n_bad, lost, weight, prior):
    """The first of the trusted quantiles with the largest share of bad scores below it, less the weighted loss."""
    gain = [sum(b < g for b in bad) / len(bad) * n_bad / (n_bad + prior) - weight * x for g, x in zip(good, lost)]
    return good[max(range(len(good)), key=lambda i: (gain[i], -i))]


def greedy_factors(docs, window):
    """Per document (first, end, document, first word there) of the factors: at each word, the first other place of the
    ``window`` words from there begins or continues a factor."""
    places = {}
    for d, words in enumerate(docs):
        for i in range(len(words) - window + 1):
            places.setdefault(tuple(words[i : i + window]), []).append((d, i))
    out = []
    for d, words in enumerate(docs):
        factors = []
        for i in range(len(words) - window + 1):
            other = [p for p in places[tuple(words[i : i + window])] if p != (d, i)]
            if not other:
                continue
            r, p = other[0]
            if factors:
                a, b, r0, p0 = factors[-1]
                if b == i + window - 1 and r == r0 and p == p0 + i - a:
                    factors[-1] = (a, b + 1, r0, p0)
                    continue
            factors.append((i, i + window, r, p))
        out.append(factors)
    return out


def dictionaries(rows, total):
    """Raw dictionary per language from all (text, language) pairs, of at most ``total`` bytes each."""
    import regex

    texts, used = Counter(), {}
    for text, lang in rows:
        if not text or lang is None:
            continue
        texts[lang] += 1
        if len(text) > 16384:
            step = (len(text) - 4096) / 3
            text = "\n".join(text[int(step * i) :][:4096] for i in range(4))
        terms = set()
        for w in regex.findall(r"\p{L}+", text.lower()):
            terms |= {w} if len(w) <= 24 else {w[i : i + 4] for i in range(len(w) - 3)}
        used.setdefault(lang, Counter()).update(terms)
    out = {}
    for lang, count in used.items():
        parts, room = [], total
        for w, n in sorted(count.items(), key=lambda x: (-x[1], x[0].encode())):
            word = b" " + w.encode()
            if n >= min(2, texts[lang]) and len(word) <= room:
                parts.append(word)
                room -= len(word)
        out[lang] = b"".join(reversed(parts)) or b" "
    return out


def language(text, contents):
    """(language, score) by the sizes of the 4096-byte pieces under every dictionary."""
    import regex
    import zstandard as z

    data = " ".join(regex.findall(r"\p{L}+", (text or "").lower())).encode()
    if not data or not contents:
        return "und", 0.0
    sizes = []
    for lang in sorted(contents):
        d = z.ZstdCompressionDict(contents[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
        c = z.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False)
        sizes.append((sum(len(c.compress(data[i : i + 4096])) for i in range(0, len(data), 4096)), lang))
    best, *rest = sorted(sizes)
    return best[1], min(1.0, (rest[0][0] - best[0]) / len(data) / 0.1) if rest else 1.0
