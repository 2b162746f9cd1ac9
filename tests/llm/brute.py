"""Plain versions of the numbered queries, one document at a time."""

import collections
import hashlib
import math
import re
import zlib

WHITE = " \t\n\r\v\f"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def listed(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def secret_base(text):
    text, out = text or "", []
    either = "".join
    names = [either(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")]
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({"|".join(names)}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return out


def random_base(text, classes, allowed, parts, window=20):
    out = []
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text or ""):
        s = m[0]
        if re.search(allowed, s):
            continue
        for kind, pattern, bits in classes:
            if re.search(pattern, s):
                taken = [m.span() for m in re.finditer(parts, s)]
                best = max(
                    (
                        -sum(c / window * math.log2(c / window) for c in collections.Counter(s[i : i + window]).values())
                        for i in range(len(s) - window + 1)
                        if all(end <= i or i + window <= start for start, end in taken)
                    ),
                    default=-1,
                )
                if best >= bits - 1e-9:
                    out.append((kind, *m.span()))
                break
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def personal_base(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def quality(text):
    words = blank_words(text)
    lines = [x for x in (text or "").split("\n") if x.strip(WHITE)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": dup,
        "n_repeat_words": len(hit),
        "base_failed": n < 10 or 100 * len(hit) > 20 * n,
    }


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items):
    """(n_words, n_hit, ids of items with a shared window)."""
    words, hit, found = plain_words(text), set(), set()
    for item_id, item_text in items:
        item = plain_words(item_text)
        n = min(10, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found)


def shingles(text):
    words = blank_words((text or "").translate(LOWER))
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def near_duplicates(rows):
    """(id, n_shingles, component id) for each row (id, text), all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by_shingle[x].append(i)
    pairs = collections.Counter((a, b) for g in by_shingle.values() for k, a in enumerate(g) for b in g[k + 1 :])
    for (a, b), inter in pairs.items():
        if 100 * inter >= 75 * (len(sets[a]) + len(sets[b]) - inter):
            parent[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


# The control strings of the chat template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def chat(rows):
    """{conv: (n_turns, turns digest, loss_chars, loss digest)} of rows (conv, turn, role, text)."""
    whole = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        whole[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in whole.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[conv] = len(turns), sha(said), len(loss), sha(loss)
    return out


def repeated_words(texts, least=50):
    """For each text the set of word places inside a passage of ``least`` words that occurs elsewhere too."""
    words = [blank_words((t or "").translate(LOWER)) for t in texts]
    seen = collections.Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for w in words:
        hit = set()
        for i in range(len(w) - least + 1):
            if seen[tuple(w[i : i + least])] > 1:
                hit.update(range(i, i + least))
        out.append(hit)
    return out


def unigram(rows):
    """{id: (held_out, n_tokens, n_known, N, base)} of rows (id, text)."""
    import zlib

    def toks(t):
        return [*blank_words((t or "").translate(LOWER)), None]

    rest = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in rows}
    counts = collections.Counter(w for i, t in rows if rest[i] != 2 for w in toks(t))
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        c = [counts[w] for w in toks(t)]
        base = sum(math.log10((x + 1) / (total + distinct + 1)) for x in c)
        out[i] = rest[i] == 2, len(c), sum(x > 0 for x in c), total, base
    return out


# --- lengths, importance, infill -----------------------------------------------------


def draws(key, seed=42):
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def infilled(key, text, marks=("<P>", "<S>", "<M>"), rate=50, spm_rate=80):
    """n, form, width of the prefix, width of the middle, output."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, (h1, h2, h3, h4) = len(units), draws(key)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


def resampled(docs, target, percent=5, least=20, buckets=10_000):
    """(key, features, weight, score, rank) of each of the documents (key, text)."""

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in runs]

    rows = [(key, *features(text)) for key, text in docs]
    s = collections.Counter(b for _, _, found in rows for b in found)
    t = collections.Counter(b for text in target for b in features(text)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    scored = []
    for key, n, found in rows:
        weight = sum(map(gain, found))
        scored.append((key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((draws(key)[0] + 0.5) / 2**32)))))
    order = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = len(order) * percent // 100
    ranked = [(*r, i + 1 if i < drawn else None) for i, r in enumerate(order)]
    return [(k, f, w, sc, rank) for k, _, f, w, sc, rank in [*ranked, *((*r, None) for r in scored if r[1] < least)]]
