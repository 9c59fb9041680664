"""Plain versions of what the operators compute, for small inputs."""

import re


def line_dedup(rows, min_words=50):
    """rows: (doc_id, text) in order; returns the texts without later copies, trying every run of every length."""
    seqs = []
    for r, (_, text) in enumerate(rows):
        for p, line in enumerate((text or "").split("\n")):
            n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
            if n:
                seqs.append((r, p, line, n))
    by_doc = {}
    for r, p, line, n in seqs:
        by_doc.setdefault(r, []).append((p, line, n))
    first, gone = {}, set()
    for r in sorted(by_doc):
        lines = by_doc[r]
        for a in range(len(lines)):
            words, key = 0, ()
            for b in range(a, len(lines)):
                words += lines[b][2]
                key += (lines[b][1],)
                if words >= min_words:
                    if key in first and first[key] != (r, a):
                        gone.update((r, lines[k][0]) for k in range(a, b + 1))
                    first.setdefault(key, (r, a))
    out = []
    for r, (_, text) in enumerate(rows):
        if text is None:
            out.append(None)
            continue
        if not any(k[0] == r for k in gone):
            out.append(text)
            continue
        left = [line for p, line in enumerate(text.split("\n")) if (r, p) not in gone]
        out.append("\n".join(left) if any(re.search(r"[^\x20\x09-\x0D]", x) for x in left) else "")
    return out
