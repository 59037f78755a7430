"""Repair of conversations: the cheapest edits that give a legal order of roles.

A conversation is legal when its roles' initials match ``(s?(ua)+)?``. Edits are Keep (0),
Rerole to user or assistant (1), Delete (2; the only one for blank rows and copies of an
earlier row) and Insert of an empty row (5); a truncated row that stays costs 5 more. Of the
cheapest edits, those whose initials in order are the least as ASCII text count.

**Weights.** The rows of a conversation and the states of the pattern make a directed graph
without cycles. The weight of a path's rest is one integer: the high digits are its cost, the
low digits its edits' letters, each in a digit of fixed place, the first one highest, zeros
behind the last one. Putting an edit in front moves the letters down a digit, into the zeros.
The least integer is thus the cheapest rest and, of equal costs, the ASCII-least (a shorter
one before its continuations), so that a plain minimum per node, from the last row to the
first, decides everything.

**Size.** Rows are sorted by conversation and streamed: a task holds a byte per row of the one
conversation it is at, and its texts up to 8 MB, beyond that in a temporary file of the task
that goes with the conversation. Conversations of more than ``BLOCK`` rows are cut into blocks whose
weights are integers of the block's width, one per pair of states; the blocks' results are
joined from the last to the first. Time is in proportion to rows. The rows of one conversation are hashed in
order, which is the work of one task by the nature of the hash; nothing else is.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows whose weights are single integers; longer conversations are joined from blocks of as many.
BLOCK = 4096
_MEMORY_BYTES = 8 << 20
# White space of the blank and truncation rules.
_SPACE = "\t\n\x0b\x0c\r "

# Costs of the edits and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Digits of the letters in ASCII order; 0 pads the end.
_LETTERS = "\0DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_DIGIT = 3

# States: nothing yet, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = "sua"
_NEXT = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER,
         ("a", _USER): _ASSISTANT}
_LEGAL_PAIRS = {"su", "ua", "au"}
_FINE, _CUT, _GONE = range(3)

REPORT = "n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
    "repaired_sha256 string"
_ROWS = "place long, edit string, role string, text string"
_READ = ("conv", "turn", "role", "text", "copies", "first", "blank", "cut")


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv, turn, role, text, copies``: the rows after damage by the CRC-32 of ``conv:turn``.

    Remainders by 20: 0 drops the row (``copies`` 0), 1 empties its text, 2 takes its ``.!?``
    out, 3 repeats it (``copies`` 2), 4 makes it a user's. NULLs count as one space, but the
    ids and turns stay NULL. Other columns are left behind, whatever their names.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(conv.cast("string"), space), F.coalesce(turn.cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(f"`{text_col}`"), space)
    return rows.select(
        conv.alias("conv"), turn.alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(f"`{role_col}`"), space)).alias("role"),
        F.when(fate <= 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The same columns of rows that are to be repaired as they are."""
    space = F.lit(" ")
    return rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), space).alias("text"), F.lit(1).alias("copies"),
    )


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation of :func:`damaged` or :func:`undamaged` rows: faults, cost and edits of the repair.

    Rows stand by turn (NULL first), then by role and text; a row without an earlier one of its
    role and text is no duplicate, and each row counts with its first fault. ``gaps`` are the
    turns missing between the smallest and the largest. A conversation without rows has zeros,
    no edits and the hash of nothing; NULL is a conversation like others; no row comes out for
    an empty table. ``repaired_sha256`` is over ``role:text`` of the repaired rows, joined by
    line breaks. A role whose initial is none of ``s``, ``u``, ``a`` (an empty one too) can't stay.
    """
    conv = dict(rows.dtypes)["conv"]
    return _sorted(rows).mapInArrow(_task(_report), f"conv {conv}, {REPORT}")


def repaired(rows: DataFrame) -> DataFrame:
    """``conv, place, edit, role, text``: the rows of every conversation after its repair.

    ``edit`` is the letter of the edit that made the row; inserted rows have an empty text.
    """
    return _sorted(rows).mapInArrow(_task(_rows), f"conv {dict(rows.dtypes)['conv']}, {_ROWS}")


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows by conversation and place, with what the faults are read from."""
    kept = F.rtrim("text", F.lit(_SPACE))
    # Dropped rows are kept apart, so that they are nobody's earlier row.
    seen = Window.partitionBy("conv", "role", "text", F.col("copies") == 0).orderBy(F.col("turn").asc_nulls_first())
    return (
        rows.select(
            "*", (F.row_number().over(seen) == 1).alias("first"), (kept == "").alias("blank"),
            (~F.right(kept, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        )
        .repartition("conv")
        .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", F.col("first").desc())
    )


class _Conversation:
    """What a task holds of the conversation it is at."""

    def __init__(self, conv, conv_type: pa.DataType | None = None):
        self.conv, self.conv_type = conv, conv_type
        self.codes = bytearray()
        self.parts = array("q")
        self.texts = tempfile.SpooledTemporaryFile(_MEMORY_BYTES)
        self.faults = [0, 0, 0]
        self.illegal, self.before = 0, None
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn, role: str, text: str, copies: int, first: bool, blank: bool, cut: bool) -> None:
        initial = role[:1]
        for copy in range(copies):
            fault = 0 if blank else 1 if copy or not first else 2 if cut else None
            if fault is not None:
                self.faults[fault] += 1
            state = _FINE if fault is None else _CUT if fault == 2 else _GONE
            # An initial beyond s, u, a is 3.
            self.codes.append(state * 4 + (_INITIALS.find(initial) if initial in ("s", "u", "a") else 3))
            if state != _GONE:
                role_bytes, text_bytes = role.encode("utf-8"), text.encode("utf-8")
                self.texts.write(role_bytes)
                self.texts.write(text_bytes)
                self.parts.extend((len(role_bytes), len(text_bytes)))
            else:
                self.parts.extend((0, 0))
            if self.before is not None and self.before + initial not in _LEGAL_PAIRS:
                self.illegal += 1
            self.before = initial
        if copies and turn is not None:
            if self.high is None or turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)

    def repaired(self, audit: str) -> Iterator[tuple[str, str, bytes]]:
        """Edit, role and text of every row after the edits."""
        self.texts.seek(0)
        at, assistant = 0, False
        for letter in audit:
            if letter == "I":
                role, text = "assistant" if assistant else "user", b""
            else:
                n_role, n_text = self.parts[2 * at], self.parts[2 * at + 1]
                at += 1
                role, text = self.texts.read(n_role).decode("utf-8"), self.texts.read(n_text)
                if letter == "D":
                    continue
                if letter == "R":
                    role = "assistant" if assistant else "user"
            assistant = role[:1] == "u"
            yield letter, role, text

    def close(self) -> None:
        self.texts.close()


def cheapest(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and letters of the least edits; a code is ``4 * fault + initial`` (3: no known initial)."""
    n = len(codes)
    starts = range(0, max(n, 1), block)
    last = starts[-1]
    # The rest from each state: its cost, and its letters as a chain of texts.
    rest: list = [None] * 4
    for state, weight, width in _weights(codes[last:], (_START, _ASSISTANT), True):
        rest[state] = (weight >> _DIGIT * width, (_letters(weight, width), None))
    for start in reversed(starts[:-1]):
        part = codes[start : start + block]
        found: list = [None] * 4
        for end in range(4):
            if rest[end] is None:
                continue
            for state, weight, width in _weights(part, (end,), False):
                way = ((weight >> _DIGIT * width) + rest[end][0], (_letters(weight, width), rest[end][1]))
                if found[state] is None or _precedes(way, found[state]):
                    found[state] = way
        rest = found
    cost, chain = rest[_START]
    texts = []
    while chain is not None:
        texts.append(chain[0])
        chain = chain[1]
    return cost, "".join(texts)


def _weights(codes: bytes, ends: tuple[int, ...], close: bool) -> Iterator[tuple[int, int, int]]:
    """State, weight and number of digits of the least way from each state to one of ``ends``.

    ``close`` allows inserts behind the last row; between blocks the next one makes them.
    """
    width = 3 * len(codes) + 2
    top, cost_at = _DIGIT * (width - 1), _DIGIT * width
    letters = (1 << cost_at) - 1
    never = 1 << (cost_at + 60)

    def put(letter: int, cost: int, weight: int) -> int:
        low = weight & letters
        return weight - low + (cost << cost_at) + (letter << top) + (low >> _DIGIT)

    def with_inserts(best: list[int]) -> list[int]:
        # More than two in a row lead back to a state at a higher cost.
        more = best
        for _ in range(2):
            user, assistant = put(_I, INSERT, more[_USER]), put(_I, INSERT, more[_ASSISTANT])
            more = [min(best[0], user), min(best[1], user), min(best[2], assistant), min(best[3], user)]
        return more

    best = [0 if s in ends else never for s in range(4)]
    if close:
        best = with_inserts(best)
    for code in reversed(codes):
        fault, initial = divmod(code, 4)
        ways = [put(_D, DELETE, w) for w in best]
        if fault != _GONE:
            extra = TRUNCATED if fault == _CUT else 0
            user, assistant = put(_R, REROLE + extra, best[_USER]), put(_R, REROLE + extra, best[_ASSISTANT])
            ways = [min(ways[0], user), min(ways[1], user), min(ways[2], assistant), min(ways[3], user)]
            if initial < 3:
                for state in range(4):
                    after = _NEXT.get((_INITIALS[initial], state))
                    if after is not None:
                        ways[state] = min(ways[state], put(_K, KEEP + extra, best[after]))
        best = with_inserts(ways)
    for state, weight in enumerate(best):
        if weight < never:
            yield state, weight, width


def _letters(weight: int, width: int) -> str:
    octal = format(weight & ((1 << _DIGIT * width) - 1), f"0{width}o").rstrip("0")
    return octal.translate({ord(str(i)): letter for i, letter in enumerate(_LETTERS)})


def _precedes(one: tuple, other: tuple) -> bool:
    """Cheaper, or as cheap and of ASCII-less letters; chains are compared as far as they are equal."""
    if one[0] != other[0]:
        return one[0] < other[0]
    (a, rest_a), (b, rest_b) = one[1], other[1]
    while True:
        n = min(len(a), len(b))
        if a[:n] != b[:n]:
            return a < b
        a, b = a[n:], b[n:]
        while not a and rest_a is not None:
            a, rest_a = rest_a
        while not b and rest_b is not None:
            b, rest_b = rest_b
        if not a or not b:
            return not a and bool(b)


def _report(conversation: _Conversation) -> Iterator[tuple]:
    cost, audit = cheapest(bytes(conversation.codes))
    digest, between = hashlib.sha256(), b""
    for _, role, text in conversation.repaired(audit):
        digest.update(between + role.encode("utf-8") + b":")
        digest.update(text)
        between = b"\n"
    yield (
        conversation.conv, len(conversation.codes), conversation.gaps, *conversation.faults, conversation.illegal,
        cost, audit, digest.hexdigest(),
    )


def _rows(conversation: _Conversation) -> Iterator[tuple]:
    _, audit = cheapest(bytes(conversation.codes))
    for place, (letter, role, text) in enumerate(conversation.repaired(audit)):
        yield conversation.conv, place, letter, role, text.decode("utf-8")


def _task(result):
    report = result is _report
    fields = [f.split() for f in (REPORT if report else _ROWS).split(", ")]
    names = ["conv", *[name for name, _ in fields]]
    types = [pa.int64() if kind == "long" else pa.string() for _, kind in fields]

    def batch_of(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [conv, *types])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, conv_type = [], 0, None
        for conversation in _conversations(batches):
            conv_type = conversation.conv_type
            for made in result(conversation):
                out.append(made)
                size += sum(len(x) for x in made if isinstance(x, str))
                if size > _MEMORY_BYTES or len(out) == 10_000:
                    yield batch_of(out, conv_type)
                    out, size = [], 0
            conversation.close()
        if out:
            yield batch_of(out, conv_type)

    return run


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[_Conversation]:
    current = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in _READ]
        for conv, *row in zip(*columns):
            if current is None or current.conv != conv:
                if current is not None:
                    yield current
                current = _Conversation(conv, batch.schema.field("conv").type)
            current.add(*row)
    if current is not None:
        yield current


ORACLE = """
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_prepend(4294967295, flatten(list_transform(range(1, length(key) + 1),
        lambda i: list_transform(range(8), lambda b: (ascii(substr(key, i, 1)) >> b) & 1)))),
      lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END
    ), 4294967295) % 20 AS fate
  FROM keyed
), copied AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
), ids AS (
  SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)
), placed AS (
  SELECT cid, turn, role, text, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    substr(role, 1, 1) AS initial,
    regexp_extract(text, '([^ \\t\\n\\v\\f\\r])[ \\t\\n\\v\\f\\r]*$', 1) AS last_mark
  FROM copied JOIN ids ON copied.conv_id IS NOT DISTINCT FROM ids.conv_id
), rows AS (
  SELECT *, CASE WHEN last_mark = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN last_mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY cid ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS is_illegal
  FROM placed
), counted AS (
  SELECT cid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE is_illegal) AS illegal
  FROM rows GROUP BY cid
), ways AS (
  SELECT cid, n + 1 AS pos, '000000000000' AS b0, '000000000010II' AS b1, '000000000005I' AS b2, '000000000000' AS b3
  FROM counted
  UNION ALL
  SELECT cid, pos, least(c0, {u2}), least(c1, {u2}), least(c2, {a2}), least(c3, {u2})
  FROM (
    SELECT *, least(c2, {a1}) AS m2, least(c3, {u1}) AS m3
    FROM (
      SELECT r.cid, r.pos,
        least({d0}, CASE WHEN stays THEN {r2} END, CASE WHEN stays AND initial = 's' THEN {k1} END,
              CASE WHEN stays AND initial = 'u' THEN {k2} END) AS c0,
        least({d1}, CASE WHEN stays THEN {r2} END, CASE WHEN stays AND initial = 'u' THEN {k2} END) AS c1,
        least({d2}, CASE WHEN stays THEN {r3} END, CASE WHEN stays AND initial = 'a' THEN {k3} END) AS c2,
        least({d3}, CASE WHEN stays THEN {r2} END, CASE WHEN stays AND initial = 'u' THEN {k2} END) AS c3
      FROM ways JOIN (
        SELECT *, fault IN ('', 'truncated') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM rows
      ) r ON r.cid = ways.cid AND r.pos = ways.pos - 1
    )
  )
), best AS (
  SELECT cid, CAST(substr(b0, 1, 12) AS BIGINT) AS cost, substr(b0, 13) AS audit FROM ways WHERE pos = 1
), letters AS (
  SELECT cid, j, substr(audit, j, 1) AS letter
  FROM (SELECT cid, audit, unnest(range(1, length(audit) + 1)) AS j FROM best)
), steps AS (
  SELECT *, sum(CASE letter WHEN 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY cid ORDER BY j) AS pos,
    sum(CASE letter WHEN 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY cid ORDER BY j) - 1 AS place
  FROM letters
), lines AS (
  SELECT s.cid, s.j, s.letter, s.place, r.role, CASE s.letter WHEN 'I' THEN '' ELSE r.text END AS text,
    first_value(s.letter = 'K' AND r.initial = 's') OVER (PARTITION BY s.cid ORDER BY s.j) AS has_system
  FROM steps s LEFT JOIN rows r ON r.cid = s.cid AND r.pos = s.pos
  WHERE s.letter <> 'D'
), fixed AS (
  SELECT cid, string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (place - CASE WHEN has_system THEN 1 ELSE 0 END) % 2 = 0 THEN 'user'
      ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS repaired
  FROM lines GROUP BY cid
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ids LEFT JOIN counted USING (cid) LEFT JOIN best USING (cid) LEFT JOIN fixed USING (cid)
""".format(**{
    name: f"lpad(CAST(CAST(substr({way}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || substr({way}, 13)"
    for name, letter, way, cost in (
        ("d0", "D", "b0", 2), ("d1", "D", "b1", 2), ("d2", "D", "b2", 2), ("d3", "D", "b3", 2),
        ("r2", "R", "b2", "1 + extra"), ("r3", "R", "b3", "1 + extra"),
        ("k1", "K", "b1", "extra"), ("k2", "K", "b2", "extra"), ("k3", "K", "b3", "extra"),
        ("u1", "I", "c2", 5), ("a1", "I", "c3", 5), ("u2", "I", "m2", 5), ("a2", "I", "m3", 5),
    )
})
