"""Plain Python versions of the operators on tokens and digests."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import sentencepiece
from tokenizers import Tokenizer

from lograft.llm.tokens import place


def counts(rows, limit=512):
    tokenizer = Tokenizer.from_file(place("byte_bpe_50k.json"))
    out = []
    for i, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        out.append((i, len((t or "").encode()), n, n > limit))
    return out


def _byte_of():
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def _tokens(text, a, b, byte_of):
    e = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def _groups(left, right):
    """Tokens up to each offset where both sides end."""
    groups, p, q, at, other = [], 0, 0, 0, 0
    while p < len(left):
        ga, gb = [], []
        while True:
            if at <= other and not (at == other and ga):
                ga.append(left[p][0])
                at += len(left[p][1])
                p += 1
            else:
                gb.append(right[q][0])
                other += len(right[q][1])
                q += 1
            if ga and gb and at == other:
                break
        groups.append((ga, gb))
    return groups


def alignment(rows):
    a = Tokenizer.from_file(place("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b, byte_of = sentencepiece.SentencePieceProcessor(model_file=place("piece_bpe_32k.model")), _byte_of()
    docs = [_tokens(t, a, b, byte_of) if t else ([], []) for _, t in rows]
    groups = [_groups(*d) for d in docs]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in groups]
    held = Counter(k for link in links for k in link)
    top: dict = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), (left, right), g, link in zip(rows, docs, groups, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((i, len(left), len(right), len(g), sum(link.values()), sum(n for k, n in link.items() if held[k] == top[k[0]]),
                    sum(n * held[k] for k, n in link.items()), hashlib.sha256(text.encode()).hexdigest() if left else ""))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda row: sha("".join(map(field, row)))
    if not rows:
        return []
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
        trees[s] = _levels([leaf(r) for r in by[s]])
    upper = _levels([trees[s][-1][0] for s in names])
    root, out = upper[-1][0], []
    for j, s in enumerate(names):
        for i, row in enumerate(by[s]):
            path = []
            for tree, k in ((trees[s], i), (upper, j)):
                for level in tree[:-1]:
                    first = k // 3 * 3
                    path.append((k - first, level[first:k], level[k + 1:first + 3]))
                    k //= 3
            shown = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                shown = (*row[:4], row[4].replace("\n", ""))
            node = leaf(shown)
            for _, before, after in path:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join(x for _, before, after in path for x in before + after))
            out.append((row[0], leaf(row), trees[s][-1][0], root, proof, node, node == root))
    return out
