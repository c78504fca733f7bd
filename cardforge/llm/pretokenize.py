"""Pre-tokenisation without a regular expression: codepoint-class arrays and an
associative scan over transition functions.

Every character becomes one of eight symbols (its class plus what follows it),
every symbol a function on the states of a small automaton.  The functions
generated by composition form a finite monoid, tabulated once; so the state
before each block of characters is a prefix product over block products, and
both passes are table lookups over whole arrays.  A character that starts a
document resets the state, so one scan serves many documents.

The tokens are those of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import functools

import numpy as np
import regex

# symbols
LETTER, NUMBER, OTHER, JOIN_SPACE, LAST_SPACE, MORE_SPACE, SHORT_APOS, LONG_APOS = range(8)
# states: END = the next character starts a token
END, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_SPACE, WANT_ONE, WANT_TWO = range(8)
RESET = 8  # added to the symbol of a document's first character
BLOCK = 256

#: White_Space of the Unicode character database (fixed values)
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
         0x3000]


@functools.cache
def codepoint_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or MORE_SPACE for every codepoint."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for name, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for start, stop in ((0, 0xD800), (0xE000, 0x110000)):
            every = "".join(map(chr, range(start, stop)))
            for m in regex.finditer(name, every):
                out[start + m.start():start + m.end()] = value
    out[WHITE] = MORE_SPACE
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether the character starts a token."""
    if symbol == LETTER:
        if state == WANT_TWO:
            return WANT_ONE, False
        if state == WANT_ONE:
            return END, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol in (OTHER, SHORT_APOS, LONG_APOS):
        if state in (IN_OTHER, AFTER_SPACE):
            return IN_OTHER, False
        return {OTHER: IN_OTHER, SHORT_APOS: WANT_ONE, LONG_APOS: WANT_TWO}[symbol], True
    if symbol == JOIN_SPACE:
        return AFTER_SPACE, True
    if symbol == LAST_SPACE:
        return END, True
    return IN_SPACE, state != IN_SPACE


@functools.cache
def _tables():
    """Generators' ids, product table, functions, next-state and start tables."""
    step = np.zeros((8, 16), dtype=np.uint8)
    starts = np.zeros((8, 16), dtype=bool)
    for s in range(8):
        for y in range(8):
            step[s, y], starts[s, y] = _step(s, y)
            step[s, y + RESET], starts[s, y + RESET] = _step(END, y)[0], True
    gens = [tuple(int(step[s, y]) for s in range(8)) for y in range(16)]
    ids: dict[tuple, int] = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    while queue:
        f = queue.pop()
        for g in gens:
            h = tuple(g[x] for x in f)  # f, then g
            if h not in ids:
                ids[h] = len(ids)
                queue.append(h)
    functions = np.array(list(ids), dtype=np.uint8)
    size = len(ids)
    product = np.zeros((size, size), dtype=np.uint16)
    for f, i in ids.items():
        for g, j in ids.items():
            product[i, j] = ids[tuple(g[x] for x in f)]
    by_gen = np.array([ids[g] for g in gens], dtype=np.uint16)
    return by_gen, product, functions, step, starts


def token_starts(symbols: np.ndarray) -> np.ndarray:
    """True where a token starts; ``symbols`` as made by :func:`symbols_of`."""
    by_gen, product, functions, step, starts = _tables()
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=bool)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, MORE_SPACE, dtype=np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    # block products
    size = len(product)
    flat = product.ravel().astype(np.int32)
    gen = by_gen.astype(np.int32)
    total = gen[columns[0]]
    for j in range(1, BLOCK):
        total = flat[total * size + gen[columns[j]]]
    # inclusive prefix products of the blocks, doubling the reach each step
    reach = 1
    while reach < blocks:
        moved = total.copy()
        moved[reach:] = flat[total[:-reach] * size + total[reach:]]
        total, reach = moved, reach * 2
    state = np.full(blocks, END, dtype=np.int32)
    state[1:] = functions[total[:-1], END]
    # the state is known before each block: walk all blocks side by side
    step_flat, start_flat = step.ravel().astype(np.int32), starts.ravel()
    out = np.empty((BLOCK, blocks), dtype=bool)
    for j in range(BLOCK):
        at = state * 16 + columns[j]
        out[j] = start_flat[at]
        state = step_flat[at]
    return out.T.ravel()[:n]


def symbols_of(cp: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
    """Symbols of codepoints ``cp``; ``doc_start`` has the index of each
    (non-empty) document's first character."""
    sym = codepoint_classes()[cp]
    n = len(cp)
    first = np.zeros(n + 2, dtype=bool)
    first[doc_start] = True
    first[n:] = True
    space = sym == MORE_SPACE
    ends = first[1:n + 1]  # the next character is not of this document
    joined = space & ~ends
    joined[:-1] &= ~space[1:]
    sym[joined] = np.where(cp[joined] == 0x20, JOIN_SPACE, LAST_SPACE)
    apos = np.flatnonzero((cp == 0x27) & ~ends)
    if len(apos):
        one = cp[apos + 1]
        sym[apos[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT_APOS
        more = ~first[apos + 2]
        apos, one = apos[more], one[more]
        two = cp[apos + 2]
        long = np.zeros(len(apos), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        sym[apos[long]] = LONG_APOS
    sym[doc_start] += RESET
    return sym


def boundaries(data: bytes | memoryview, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the tokens of UTF-8 ``data`` (with the end as last
    entry), and for each document (``offsets``: its byte bounds) the index of
    its first token (with the number of tokens as last entry)."""
    raw = np.frombuffer(data, dtype=np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32 if len(raw) < 1 << 31 else np.int64)
    cp = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), dtype="<u4")
    lo, hi = offsets[:-1], offsets[1:]
    doc_start = np.searchsorted(lead, lo[hi > lo])
    at = np.flatnonzero(token_starts(symbols_of(cp, doc_start)))
    bounds = np.append(lead[at], len(raw)).astype(np.int64)
    return bounds, np.searchsorted(bounds[:-1], offsets)
