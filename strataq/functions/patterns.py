"""LIKE pattern text."""


def normalise_like(pattern: str) -> str:
    r"""Rewrite a LIKE pattern so that Spark accepts it.

    A backslash before any character makes that character literal and a trailing backslash is a
    literal backslash; Spark only accepts a backslash before ``%``, ``_`` and itself.
    """
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c != "\\":
            out.append(c)
            i += 1
            continue
        nxt = pattern[i + 1 : i + 2]
        out.append("\\\\" if nxt in ("", "\\") else "\\" + nxt if nxt in "%_" else nxt)
        i += 2
    return "".join(out)
