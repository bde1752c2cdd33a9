"""Independent emulation of the Java string rules, for property tests.

Written from the Java API contracts, not from the Spark code under test.
"""

import re

KEYS = ("action", "stockcode", "mobilecode", "uniqueid", "code")


def jsplit(s: str, regex: str) -> list[str]:
    parts = re.split(regex, s)
    if len(parts) == 1:          # no match: the input itself
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def jtrim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def pair(line: str):
    ps = jsplit(line, "=")
    return (jtrim(ps[0]), jtrim(ps[1])) if len(ps) == 2 else None


def utf16_prefix2(s: str):
    """Java ``s.substring(0, 2)`` (None when it throws).  A leading astral
    character is two UTF-16 units on its own; a surrogate pair cut in half
    (BMP char then astral char) cannot exist in UTF-8 and is kept whole."""
    if s and ord(s[0]) > 0xFFFF:
        return s[0]
    return s[:2] if len(s) >= 2 else None


def t4(value: str):
    """Message -> list of documents, or None when the message is rejected."""
    docs = []
    for part in jsplit(value, "-{10}"):
        lines = jsplit(part, "\n")
        if not lines:
            return None
        first = lines[0]
        if utf16_prefix2(first) is None:
            return None
        segs = jsplit(first, ">")
        if len(segs) < 2:
            return None
        sq = jsplit(segs[1], r"\[")
        if not sq:
            return None
        obj = {"logtype": utf16_prefix2(first), "uniquestr": sq[0]}
        for ln in lines:
            p = pair(ln)
            if p:
                obj[p[0].lower()] = p[1]
        docs.append(obj)
    return docs


def t6(value: str) -> list[str]:
    out = []
    for part in jsplit(value, "-{10}"):
        for ln in jsplit(part, "\n"):
            p = pair(ln)
            if p and p[0].lower() == "stockcode":
                out.append(p[1].lower())
    return out


def t9(value: str):
    out = []
    for pos, part in enumerate(jsplit(value, "-{10}")):
        obj = {}
        for ln in jsplit(part, "\n"):
            p = pair(ln)
            if p and p[0].lower() in KEYS:
                obj[p[0].lower()] = p[1].lower()
        action = obj.get("action", "")
        if action not in ("20109", "10001"):
            continue
        if action == "10001" and obj.get("code", "") != "":
            obj["stockcode"] = obj.pop("code")
        if obj.get("mobilecode", "") == "" and obj.get("uniqueid", "") != "":
            usersign = obj["uniqueid"]
        else:
            usersign = obj.get("mobilecode", "")
        out.append((pos, obj.get("stockcode"), obj.get("code"), usersign))
    return out


def t2(value: str):
    """(record pos, line pos, key, value) for every accepted pair."""
    out = []
    for rp, part in enumerate(jsplit(value, "-{10}")):
        for lp, ln in enumerate(part.split("\n")):  # positions over all lines
            p = pair(ln)
            if p:
                out.append((rp, lp, p[0].lower(), p[1]))
    return out


def t3(value: str):
    """(record pos, ok, logtype, uniquestr) per record."""
    out = []
    for rp, part in enumerate(jsplit(value, "-{10}")):
        lines = jsplit(part, "\n")
        first = lines[0] if lines else ""
        head = utf16_prefix2(first)
        segs = jsplit(first, ">") if head is not None else []
        sq = jsplit(segs[1], r"\[") if len(segs) >= 2 else []
        if head is not None and len(segs) >= 2 and sq:
            out.append((rp, True, head, sq[0]))
        else:
            out.append((rp, False, None, None))
    return out
