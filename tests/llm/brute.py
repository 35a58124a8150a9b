"""Plain versions of the operators, one row at a time."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import struct
import zlib

import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    words = WORD.findall(low(text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(docs):
    """doc_id -> (n_shingles, component) over (doc_id, text)."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        inter = collections.Counter()
        for g in s:
            inter.update(where[g])
            where[g].append(i)
        for j, n in inter.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def jump(key, shards):
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def line_key(line):
    return low(line.strip(BLANKS))


def line_dedup(docs):
    first, last = {}, {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            k = line_key(x)
            first[k], last[k] = min(first.get(k, i), i), max(last.get(k, i), i)
    out = {}
    for i, t in docs:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(line_key(x)) < 10 or first[line_key(x)] == last[line_key(x)] or first[line_key(x)] == i]
        out[i] = (len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    seen = collections.defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    repeated = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    dup, before = 0, set()
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in before
            before.add(x)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def tiktoken_encoding(name="byte_bpe_multi_50k.tiktoken"):
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_bytes(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def crc(ids):
    return zlib.crc32(ids_bytes(ids))


def top_k(rows, k=10):
    import math

    import numpy as np

    whole = {
        i: [math.floor(1024 * float(x)) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    width = max((len(v) for v in whole.values()), default=0)
    ids = np.array(list(whole), np.int64)
    m = np.array([v + [0] * (width - len(v)) for v in whole.values()], np.int64).reshape(len(ids), width)
    out = {}
    for q in ids[ids % 100 == 0]:
        s = m @ m[ids == q][0]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), int(s[i])) for i in order]
    return out


def alignment(docs):
    """doc_id -> (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), by the libraries and one token at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    back = {chr(b if b in shown else next(spare)): b for b in range(256)}
    found, counts = {}, collections.Counter()
    for i, text in docs:
        whole = b" " + (text or "").encode()
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        bytes_a = [bytes(back[c] for c in one.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode() for p in map(two.id_to_piece, b)]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found[i] = None
            continue
        ends_a, ends_b = [], []
        for ends, parts in ((ends_a, bytes_a), (ends_b, bytes_b)):
            at = 0
            for p in parts:
                at += len(p)
                ends.append(at)
        at_a, at_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
        common = sorted(at_a.keys() & at_b.keys())
        shown_groups, links, j, k = [], [], 0, 0
        for end in common:
            shown_groups.append(",".join(map(str, a[j : at_a[end] + 1])) + "|" + ",".join(map(str, b[k : at_b[end] + 1])))
            j, k = at_a[end] + 1, at_b[end] + 1
            links.append((a[j - 1], b[k - 1]))
        counts.update(links)
        found[i] = (len(a), len(b), len(common), links, hashlib.sha256(";".join(shown_groups).encode()).hexdigest())
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return {
        i: (f[0], f[1], f[2], len(f[3]), sum(counts[x] == most[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4]) if f else (0, 0, 0, 0, 0, 0, "")
        for i, f in found.items()
    }


def phrases(docs, least, top, most_words=5):
    """(lang, rank, phrase, a, l, r, n, score) over (lang, text)."""
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, most_words + 1):
                for i in range(len(words) - m + 1):
                    counts[lang or "und"][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def kept_by_rules(docs, least_texts=20, share=0.05, left=0.2):
    """[kept] over (host, text): base rules, then the words left without the lines that many texts of the host hold."""
    texts = collections.defaultdict(set)
    for host, text in docs:
        texts[host].add(text or "")
    holders = collections.defaultdict(set)
    for host, some in texts.items():
        for t in some:
            for x in t.split("\n"):
                if x.strip(BLANKS):
                    holders[host, line_key(x)].add(t)
    out = []
    for host, text in docs:
        lines = [(line_key(x), len(WORD.findall(x))) for x in (text or "").split("\n")]
        n = sum(w for _, w in lines)
        gone = sum(w for k, w in lines if w and len(holders[host, k]) >= least_texts and len(holders[host, k]) >= share * len(texts[host]))
        out.append(not base_rules(text)[-1] and n - gone >= left * n)
    return out


def url_verdicts(pages, literal_pages=20, literal_share=0.01, similar=1.96, smoothing=10.0, chance=0.05):
    """[verdict] over (host, path, label): the path tree, a node at a time from the root, then leaves merged from the deepest place up."""
    import math

    def form(path):
        return tuple("*" if re.search("[0-9]", s) else s for s in path.split("/") if s)

    def share(g, b):
        return (g + 1) / (g + b + 2)

    def apart(g, b, p, tests):
        part = lambda n, q: n * math.log(n / ((g + b) * q)) if n else 0.0
        return part(g, p) + part(b, 1 - p) > math.log(2 * tests / chance) if tests else False

    forms = collections.defaultdict(lambda: [0, 0, 0])
    for host, path, label in pages:
        f = forms[host, form(path)]
        f[0] += 1
        f[1] += label == 1
        f[2] += label == 0
    leaf, places = {}, set()

    def grow(host, members, prefix):
        """Gives each form of a node its leaf; ``prefix`` is the generalised path to the node."""
        at = len(prefix)
        longer = [f for f in members if len(f) > at]
        for f in members:
            if len(f) == at:
                leaf[host, f] = prefix
        if not longer:
            return
        same = 0
        while all(len(f) > at + same for f in longer) and len({f[at + same] for f in longer}) == 1:
            same += 1
        if same:
            return grow(host, longer, prefix + longer[0][at : at + same])
        places.add(at)
        children = collections.defaultdict(lambda: [0, 0, 0])
        for f in longer:
            for i in range(3):
                children[f[at]][i] += forms[host, f][i]
        total = sum(c[0] for c in children.values())
        rare = {v for v, c in children.items() if v != "*" and (c[0] < literal_pages or c[0] < literal_share * total)}
        words = [sum(children[v][i] for v in rare) for i in (1, 2)]
        digits = children["*"][1:] if "*" in children else [0, 0]
        both = share(words[0] + digits[0], words[1] + digits[1])
        tests = sum(children[v][1] + children[v][2] > 0 for v in rare)
        name = "*words" if apart(*words, both, 2) or apart(*digits, both, 2) else "*"
        step = {v: name if v in rare and len(rare) > 1 and not apart(*children[v][1:], share(*words), tests) else v for v in children}
        nodes = collections.defaultdict(list)
        for f in longer:
            nodes[step[f[at]]].append(f)
        for value, some in nodes.items():
            grow(host, some, (*prefix, value))

    by_host = collections.defaultdict(list)
    for host, f in list(forms):
        by_host[host].append(f)
    for host, members in by_host.items():
        grow(host, members, ())
    for at in sorted(places, reverse=True):
        leaves = collections.defaultdict(lambda: [0, 0])
        for key, own in leaf.items():
            if len(own) > at:
                leaves[key[0], own][0] += forms[key][1]
                leaves[key[0], own][1] += forms[key][2]
        pools = collections.defaultdict(list)
        for host, own in leaves:
            pools[host, (*own[:at], "*", *own[at + 1 :])].append(own)
        moves = {}
        for (host, pool), members in pools.items():
            g, b = (sum(leaves[host, m][i] for m in members) for i in (0, 1))
            alike = lambda x: abs(x[0] - sum(x) * share(g, b)) <= similar * math.sqrt(sum(x) * share(g, b) * (1 - share(g, b)))
            wild = [sum(leaves[host, m][i] for m in members if m[at] == "*") for i in (0, 1)]
            if len(members) > 1 and alike(wild):
                moves.update({(host, m): pool for m in members if m[at] != "*" and alike(leaves[host, m])})
        leaf.update({key: moves[key[0], own] for key, own in leaf.items() if (key[0], own) in moves})
    good, bad = (sum(f[i] for f in forms.values()) for i in (1, 2))
    prior = share(good, bad) if good or bad else 1.0
    held = collections.defaultdict(lambda: [0, 0])
    for key, own in leaf.items():
        held[key[0], own][0] += forms[key][1]
        held[key[0], own][1] += forms[key][2]
    purity = {k: (g + smoothing * prior) / (g + b + smoothing) for k, (g, b) in held.items()}
    return ["block" if purity[host, leaf[host, form(path)]] < 0.5 else "allow" for host, path, _ in pages]
