"""Where the pieces of a byte-level BPE pre-tokeniser begin, found without a regular expression.

Each code point gets a class from a table, each class is a function from state to state of a small automaton, and the
automaton runs over a whole batch of texts at once: functions compose associatively, so blocks of text are composed side
by side, the blocks' functions are scanned, and every block then starts in its right state.

The pieces are those of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# classes of a code point alone
LETTER, NUMBER, OTHER, SPACE = range(4)
# symbols of the automaton: a code point with what follows it
#: A letter; one that ends a contraction (s t m d); one that may begin the end of one (r before e, v before e, l before l);
#: a number; other; an apostrophe; a blank before a piece it belongs to; white space before a non-space; other white space.
A, T, R, N, O, Q, B, S, W = range(9)
SYMBOLS = 9
# states: fresh start, in letters, in numbers, in others, after an opening apostrophe, before a contraction's last letter, after white space, after a joined blank
FRESH, LETTERS, NUMBERS, OTHERS, QUOTE, TAIL, WHITE, BLANK = range(8)
STATES = 8


def _step(state: int, symbol: int) -> tuple[int, int]:
    """Next state, and 1 if a piece begins at this symbol."""
    if symbol in (A, T, R):
        if state == TAIL or (state == QUOTE and symbol == T):
            return FRESH, 0
        if state == QUOTE and symbol == R:
            return TAIL, 0
        return LETTERS, int(state not in (LETTERS, BLANK))
    if symbol == N:
        return NUMBERS, int(state not in (NUMBERS, BLANK))
    if symbol in (O, Q):
        if state in (OTHERS, QUOTE, BLANK):
            return OTHERS, 0
        return (QUOTE if symbol == Q else OTHERS), 1
    if symbol == B:
        return BLANK, 1
    if symbol == S:
        return WHITE, 1
    return WHITE, int(state != WHITE)


@cache
def tables():
    """Class of each code point; next state and beginnings by state and symbol; the functions that symbols (then symbols
    at a text's start) generate, as state maps; their composition; and the function of each symbol."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            classes[c] = LETTER
        elif major == "N":
            classes[c] = NUMBER
    classes[WHITE_SPACE] = SPACE
    nexts = np.array([[_step(s, y)[0] for y in range(SYMBOLS)] for s in range(STATES)], np.uint8)
    begins = np.array([[_step(s, y)[1] for y in range(SYMBOLS)] for s in range(STATES)], np.uint8)
    basic = [tuple(int(nexts[s][y]) for s in range(STATES)) for y in range(SYMBOLS)]
    basic += [(int(nexts[FRESH][y]),) * STATES for y in range(SYMBOLS)]
    number = {tuple(range(STATES)): 0}
    todo = [tuple(range(STATES))]
    while todo:
        f = todo.pop()
        for g in basic:
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(number)
                todo.append(h)
    maps = sorted(number, key=number.get)
    compose = np.array([[number[tuple(g[x] for x in f)] for g in maps] for f in maps], np.uint16)
    return classes, nexts, begins, np.array(maps, np.uint8), compose, np.array([number[g] for g in basic], np.uint16)


def _starts(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """The state before each of the functions, beginning FRESH: an associative scan in blocks."""
    _, _, _, maps, compose, _ = tables()
    n = len(functions)
    if n <= width:
        out = np.empty(n, np.uint8)
        state = FRESH
        for i, f in enumerate(functions):
            out[i] = state
            state = maps[f, state]
        return out
    blocks = -(-n // width)
    lanes = np.zeros(blocks * width, functions.dtype)
    lanes[:n] = functions
    lanes = np.ascontiguousarray(lanes.reshape(blocks, width).T)
    flat, m = compose.ravel(), compose.shape[1]
    whole = lanes[0].astype(np.intp)
    for row in lanes[1:]:
        whole *= m
        whole += row
        whole = flat.take(whole).astype(np.intp)
    state = _starts(whole.astype(functions.dtype), width)
    out = np.empty((width, blocks), np.uint8)
    flat_maps = maps.ravel()
    for j in range(width):
        out[j] = state
        state = flat_maps.take(lanes[j].astype(np.intp) * STATES + state)
    return np.ascontiguousarray(out.T).ravel()[:n]


def begins(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece begins. codes: code points of texts one after the other; first: True where a text begins."""
    classes, nexts, begin, _, _, basic = tables()
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    kind = classes.take(codes)
    symbol = np.array([A, N, O, W], np.uint8).take(kind)
    followed = np.zeros(n, bool)  # by a code point of the same text
    followed[:-1] = ~first[1:]
    space = kind == SPACE
    last = space & followed
    last[:-1] &= ~space[1:]
    symbol[last] = S
    symbol[last & (codes == 0x20)] = B
    symbol[codes == 0x27] = Q
    quotes = np.flatnonzero(symbol == Q)
    if len(quotes):  # only what follows an apostrophe can be part of a contraction
        for k in quotes[quotes + 1 < n] + 1:
            c = codes[k]
            if c in (0x73, 0x74, 0x6D, 0x64):
                symbol[k] = T
            elif followed[k] and (int(c), int(codes[k + 1])) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):
                symbol[k] = R
    functions = basic.take(symbol + np.uint8(SYMBOLS) * first.view(np.uint8))
    state = _starts(functions)
    state[first] = FRESH
    return begin.ravel().take(state.astype(np.intp) * SYMBOLS + symbol).astype(bool)
