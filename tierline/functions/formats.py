"""strptime-style date formats, as feeds declare them, in Spark's pattern letters."""

from __future__ import annotations

# Strptime directive -> Spark datetime pattern. The single-letter
# forms accept one or two digits, as strptime does; they are used next to a
# separator, the padded forms where digits touch.
_LOOSE = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s",
    "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%I": "h", "%p": "a", "%f": "SSSSSS",
}
_PADDED = {"%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%I": "hh"}


def spark_pattern(strptime_format: str) -> str:
    """``%m/%d/%Y`` -> ``M/d/yyyy``; ``%Y%m%d`` -> ``yyyyMMdd``."""
    tokens: list[tuple[bool, str]] = []
    i = 0
    while i < len(strptime_format):
        if strptime_format[i] == "%" and i + 1 < len(strptime_format):
            directive = strptime_format[i : i + 2]
            if directive == "%%":
                tokens.append((False, "%"))
            elif directive in _LOOSE:
                tokens.append((True, directive))
            else:
                raise ValueError(f"unsupported date directive {directive!r} in {strptime_format!r}")
            i += 2
        else:
            tokens.append((False, strptime_format[i]))
            i += 1

    out = []
    for pos, (is_directive, text) in enumerate(tokens):
        if not is_directive:
            if text == "'":
                out.append("''")
            else:
                out.append(f"'{text}'" if text.isalpha() else text)
            continue
        touches = (pos > 0 and tokens[pos - 1][0]) or (pos + 1 < len(tokens) and tokens[pos + 1][0])
        out.append(_PADDED.get(text, _LOOSE[text]) if touches else _LOOSE[text])
    return "".join(out)
