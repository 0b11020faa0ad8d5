"""A quote-aware finite automaton over delimited lines, run on many lines at once.

Each line is cut into chunks of fixed length. The state map of every chunk (which state each state leads to) is computed in
step over all chunks; the maps are composed along each line to give every chunk its true starting state; a second pass then
yields the state before each character. A very long line thus costs no more steps than a short one.
"""

from __future__ import annotations

import numpy as np

START, PLAIN, QUOTED, QUOTE, CLOSED, FAILED = range(6)
OTHER, BLANK, DELIM, QUOTEMARK, PAD = range(5)
#: Next state by character class and state.
NEXT = np.array(
    [
        [PLAIN, PLAIN, QUOTED, FAILED, FAILED, FAILED],
        [START, PLAIN, QUOTED, CLOSED, CLOSED, FAILED],
        [START, START, QUOTED, START, START, FAILED],
        [QUOTED, FAILED, QUOTE, QUOTED, FAILED, FAILED],
        [START, PLAIN, QUOTED, QUOTE, CLOSED, FAILED],
    ],
    dtype=np.uint8,
)
CHUNK = 64
_BLANKS = (" ", "\t", "\u00a0")


def clean(line: str) -> str:
    """A line without its byte order mark and closing carriage returns and line feeds."""
    return line.lstrip("\ufeff").rstrip("\r\n")


def split(lines: list[str], delim: str) -> list[tuple[list[str] | None, list[int]]]:
    """(fields, offsets) of each line, an offset being that of the first character of a field.

    Where quoting fails, fields are None and the one offset is that of the failing character or of an unclosed quote.
    """
    n = len(lines)
    lengths = np.fromiter((len(x) for x in lines), np.int64, n)
    chunks = np.maximum(1, -(-lengths // CHUNK))
    first = np.concatenate([[0], np.cumsum(chunks)])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    line_of = np.repeat(np.arange(n), lengths)
    offset = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    kind = np.zeros(len(codes), np.uint8)
    for b in _BLANKS:
        kind[codes == ord(b)] = BLANK
    kind[codes == ord('"')] = QUOTEMARK
    kind[codes == ord(delim)] = DELIM
    place = first[line_of] * CHUNK + offset
    grid = np.full(first[-1] * CHUNK, PAD, np.uint8)
    grid[place] = kind
    grid = grid.reshape(-1, CHUNK)
    maps = np.tile(np.arange(6, dtype=np.uint8), (len(grid), 1))
    for j in range(CHUNK):
        maps = NEXT[grid[:, j][:, None], maps]
    state = np.zeros(len(grid), np.uint8)
    more, k = np.flatnonzero(chunks > 1), 1
    while len(more):  # compose along each line; the k-th chunks of all longer lines together
        at = first[more] + k
        state[at] = maps[at - 1, state[at - 1]]
        k += 1
        more = more[chunks[more] > k]
    ends = maps[first[1:] - 1, state[first[1:] - 1]]
    before = np.empty(grid.shape, np.uint8)
    for j in range(CHUNK):
        before[:, j] = state
        state = NEXT[grid[:, j], state]
    before = before.reshape(-1)[place]
    cut = (kind == DELIM) & (before != QUOTED) & (before != FAILED)
    broken = NEXT[kind, before] == FAILED
    broken &= before != FAILED
    cuts = np.split(offset[cut], np.cumsum(np.bincount(line_of[cut], minlength=n))[:-1]) if n else []
    fail_at = np.full(n, -1)
    fail_at[line_of[broken]] = offset[broken]
    out: list[tuple[list[str] | None, list[int]]] = []
    for i, line in enumerate(lines):
        if ends[i] == FAILED:
            out.append((None, [int(fail_at[i])]))
        elif ends[i] == QUOTED:
            out.append((None, [line.rfind('"')]))
        else:
            begins = [0, *(cuts[i] + 1).tolist()]
            out.append(([unquote(line[a : b - 1]) for a, b in zip(begins, [*begins[1:], len(line) + 1])], begins))
    return out


def unquote(field: str) -> str:
    """The content of a field without the blanks around it and its quotes."""
    field = field.strip(" \t\u00a0")
    return field[1:-1].replace('""', '"').strip(" \t\u00a0") if field[:1] == '"' else field
