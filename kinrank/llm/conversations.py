"""Operator 11, conversation structure repair: cheapest edits by bidirectional Dijkstra.

A conversation is read as a string of symbols, one a row: who speaks and
whether the row is clean, truncated, or has to go (blank or seen before). Its
edit lattice has a node for each number of rows read and each state of the
grammar ``(s?(ua)+)?``; edges keep, rerole or delete the next row, or insert a
row. Two heaps, one from the start and one from the accepting ends, meet; both
go on until no crossing of equal cost can be missing. Every cheapest path has a
crossing that both sides know, so the first audit by ASCII is read off the edges
that lie on cheapest paths, letter by letter. (Two cheapest audits are never a
beginning of one another: what one has more would read no row and cost nothing.
And an audit tells every role: the rows left alternate, and an odd number of
them begins with the system.)

Rows shuffle twice. First without texts: by conversation and turn, a symbol
each, so the longest conversation costs a task one byte a row. Then the texts
follow their conversation's audit in order and are hashed as they pass. A hash
of a whole conversation can't be split, so its rows pass one task, but none
holds them. Which texts were seen before in a conversation is a grouping on
hashes (128 bits), joined back in SALTS parts.
"""

from __future__ import annotations

import hashlib
from array import array
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, ship
from kinrank.session import parallelism

SALTS = 8
KNOWN, SHORT = 100_000, 64            # audits that a worker keeps, of conversations of so many rows at most
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# A symbol is 4 * fault + speaker.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
CLEAN, TRUNCATED, DOOMED = range(3)
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3                     # costs; CUT: of a truncated row that stays
#: State (0 nothing yet, 1 after the system, 2 after a user, 3 after an assistant) and speaker to the next state.
STEP = ({SYSTEM: 1, USER: 2}, {USER: 2}, {ASSISTANT: 3}, {USER: 2})
ENDING = (0, 3)
FAR = 1 << 60


def _edges(symbol: int):
    """What the next row allows: (state, state after, cost, letter)."""
    fault, speaker = divmod(symbol, 4)
    out = [(q, q, DELETE, "D") for q in range(4)]
    if fault != DOOMED:
        extra = CUT if fault == TRUNCATED else 0
        for q in range(4):
            for who, to in STEP[q].items():
                if who == speaker:
                    out.append((q, to, extra, "K"))
                elif who != SYSTEM:
                    out.append((q, to, extra + REROLE, "R"))
    return out


_ROW = [_edges(s) for s in range(12)]
_INSERT = [(q, to, INSERT, "I") for q in range(4) for who, to in STEP[q].items() if who != SYSTEM]
#: By state: edges out and in, of a row and of an insertion.
_OUT = [[[e for e in edges if e[0] == q] for q in range(4)] for edges in (*_ROW, _INSERT)]
_IN = [[[e for e in edges if e[1] == q] for q in range(4)] for edges in (*_ROW, _INSERT)]


def repair(symbols: bytes) -> tuple[int, str]:
    """The cost of the cheapest edits and the first of their audits by ASCII."""
    n = len(symbols)
    ahead, back = array("q", [FAR]) * (4 * n + 4), array("q", [FAR]) * (4 * n + 4)      # node: 4 * rows read + state
    ahead[0] = 0
    forth: list[tuple[int, int]] = [(0, 0)]
    rear: list[tuple[int, int]] = []
    for q in ENDING:
        back[4 * n + q] = 0
        rear.append((0, -(4 * n + q)))
    rear.sort()
    best = FAR if n else 0
    while forth and rear and forth[0][0] + rear[0][0] <= best:
        if forth[0][0] <= rear[0][0]:
            cost, node = heappop(forth)
            if cost > ahead[node]:
                continue
            i, q = divmod(node, 4)
            for edges, on in ((_OUT[symbols[i]][q], 4) if i < n else ((), 0), (_OUT[12][q], 0)):
                for _, to, c, _ in edges:
                    other = 4 * i + on + to
                    if cost + c < ahead[other]:
                        ahead[other] = cost + c
                        heappush(forth, (cost + c, other))
                        best = min(best, cost + c + back[other])
        else:
            cost, node = heappop(rear)
            node = -node
            if cost > back[node]:
                continue
            i, q = divmod(node, 4)
            for edges, on in ((_IN[symbols[i - 1]][q], 4) if i else ((), 0), (_IN[12][q], 0)):
                for come, _, c, _ in edges:
                    other = 4 * i - on + come
                    if cost + c < back[other]:
                        back[other] = cost + c
                        heappush(rear, (cost + c, -other))
                        best = min(best, cost + c + ahead[other])
    # nodes before the crossings that lie on cheapest paths
    todo = [v for v in range(4 * n + 4) if ahead[v] + back[v] == best]
    on_path = bytearray(4 * n + 4)
    for v in todo:
        on_path[v] = 1
    while todo:
        node = todo.pop()
        i, q = divmod(node, 4)
        for edges, on in ((_IN[symbols[i - 1]][q], 4) if i else ((), 0), (_IN[12][q], 0)):
            for come, _, c, _ in edges:
                other = 4 * i - on + come
                if not on_path[other] and ahead[other] + c == ahead[node]:
                    on_path[other] = 1
                    todo.append(other)
    audit, here = [], {0: False}                             # node: whether a crossing has been passed
    while True:
        here = {v: past or ahead[v] + back[v] == best for v, past in here.items()}
        if any(past and back[v] == 0 and v >= 4 * n for v, past in here.items()):
            break
        found: dict[str, dict[int, bool]] = {}
        for node, past in here.items():
            i, q = divmod(node, 4)
            for edges, on in ((_OUT[symbols[i]][q], 4) if i < n else ((), 0), (_OUT[12][q], 0)):
                for _, to, c, letter in edges:
                    other = 4 * i + on + to
                    if past and back[node] == c + back[other]:
                        found.setdefault(letter, {})[other] = True
                    elif on_path[node] and on_path[other] and ahead[node] + c == ahead[other]:
                        found.setdefault(letter, {}).setdefault(other, False)
        letter = min(found)
        audit.append(letter)
        here = found[letter]
    return best, "".join(audit)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with null conv_id and turn as they are, null roles and texts as
    one space, and what crc32 of ``conv_id:turn`` (null: one space) modulo 20
    does to them: 0 leaves none (``copies`` 0), 1 no text, 2 no full stops,
    question or exclamation marks, 3 two ``copies``, 4 the role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(h == 4, F.lit("user")).otherwise(part("role")).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text")).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))


def _name(conv_id: Column) -> Column:
    """The conversation as a string that is never null."""
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _symbols(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``_c, _h, _g``) without texts, with their symbols but for
    repetitions inside one turn, which stand side by side once sorted."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    first = F.substring("role", 1, 1)
    speaker = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    slim = rows.select("_c", "conv_id", "turn", "role", "_h", "_g", "copies", first.alias("who"), speaker.alias("speaker"),
                       (last == "").alias("blank"), (~last.isin(*ENDS)).alias("cut"))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    again = (slim.where("copies > 0").groupBy("_c", "_h", "_g").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("_first"))
             .where("n > 1").drop("n").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    slim = slim.withColumn("_s", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    return (slim.join(again, ["_c", "_h", "_g", "_s"], "left")
            .withColumn("later", F.coalesce(place > F.col("_first"), F.lit(False))).drop("_s", "_first"))


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What is known of a conversation while its rows pass in order."""

    def __init__(self, conv_id):
        self.conv_id, self.symbols = conv_id, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.who = self.before = None

    def add(self, turn, key, who, speaker, blank, cut, later, copies):
        for copy in range(copies):
            if blank:
                self.blank += 1
                fault = DOOMED
            elif later or copy or self.before == (turn, key):
                self.duplicate += 1
                fault = DOOMED
            else:
                self.truncated += cut
                fault = TRUNCATED if cut else CLEAN
            self.before = turn, key
            self.illegal += self.who is not None and self.who + who not in ("su", "ua", "au")
            self.who = who
            self.symbols.append(4 * fault + speaker)
        if copies and turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def report(self, known: dict[bytes, tuple[int, str]]):
        key = bytes(self.symbols)
        found = known.get(key) or repair(key)
        if len(key) <= SHORT:
            if len(known) >= KNOWN:
                known.clear()
            known[key] = found
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *found


def _reports(batches, kind):
    known: dict[bytes, tuple[int, str]] = {}
    name, now = None, None

    def batch(done):
        cols = list(zip(*[(c, x.conv_id, *x.report(known)) for c, x in done]))
        kinds = [pa.string(), kind, *[pa.int64()] * 6, pa.string()]
        names = ["_c", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names=names)

    for b in batches:
        done = []
        for c, conv_id, turn, h, g, copies, who, speaker, blank, cut, later in zip(*[x.to_pylist() for x in b.columns]):
            if c != name:
                if now is not None:
                    done.append((name, now))
                name, now = c, _Conversation(conv_id)
            now.add(turn, (h, g), who, speaker, blank, cut, later, copies)
        if done:
            yield batch(done)
    if now is not None:
        yield batch([(name, now)])


class _Repaired:
    """The rows of a repaired conversation, hashed one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.said = audit, 0, 0
        self.odd = sum(map(audit.count, "KRI")) % 2
        self.hash = hashlib.sha256()

    def _say(self, role, text):
        role = role or ("user", "assistant")[(self.said - self.odd) % 2]
        self.hash.update(("\n" * (self.said > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.said += 1

    def insertions(self):
        while self.audit[self.at:self.at + 1] == "I":
            self._say("", "")
            self.at += 1

    def row(self, role, text):
        self.insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._say(role if letter == "K" else "", text)

    def digest(self) -> str:
        self.insertions()
        return self.hash.hexdigest()


def _hashes(batches, names, kinds):
    """Reports with the hash of the rows that follow them."""
    report, now = None, None

    def batch(done):
        cols = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names=names)

    for b in batches:
        done = []
        cols = [x.to_pylist() for x in b.columns]
        for is_row, role, text, copies, *own in zip(*cols):
            if not is_row:
                if report is not None:
                    done.append((*report, now.digest()))
                report, now = own, _Repaired(own[-1])
                continue
            for _ in range(copies):
                now.row(role, text)
        if done:
            yield batch(done)
    if report is not None:
        yield batch([(*report, now.digest())])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts of faults, ``cost``, ``audit`` and ``repaired_sha256``,
    one row for each conv_id of ``rows`` (null ones are one conversation).

    ``rows`` has conv_id, turn, role, text (none null but ids and turns) and
    ``copies``: how often a row stands; a conversation whose rows all stand no
    times is empty. Rows are taken by turn, nulls first; of one turn by role,
    then by a hash of role and text, so rows alike stand side by side. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    rows = rows.select(_name(F.col("conv_id")).alias("_c"), "conv_id", "turn", "role", "text", "copies",
                       F.xxhash64("role", "text").alias("_h"), F.xxhash64("text", F.lit(1), "role").alias("_g"))
    order = ["role", "_h", "_g"]
    n = parallelism(spark)
    slim = (_symbols(rows).repartition(n, "_c").sortWithinPartitions("_c", F.col("turn").asc_nulls_first(), *order)
            .select("_c", "conv_id", "turn", "_h", "_g", "copies", "who", "speaker", "blank", "cut", "later"))
    reports = slim.mapInArrow(lambda b: _reports(b, arrow), f"_c string, conv_id {kind.simpleString()}, {REPORT}")
    names = [c for c in reports.columns if c != "_c"]
    missing = lambda c, t: F.lit(None).cast(t).alias(c)
    heads = reports.select("_c", F.lit(False).alias("_row"), missing("turn", "long"), missing("role", "string"), missing("_h", "long"),
                           missing("_g", "long"), missing("text", "string"), F.lit(0).alias("copies"), *names)
    texts = rows.where("copies > 0").select("_c", F.lit(True).alias("_row"), "turn", "role", "_h", "_g", "text", "copies",
                                            *[missing(c, reports.schema[c].dataType) for c in names])
    stream = (heads.unionByName(texts).repartition(n, "_c")
              .sortWithinPartitions("_c", "_row", F.col("turn").asc_nulls_first(), *order)
              .select("_row", "role", "text", "copies", *names))
    kinds = [arrow, *[pa.int64()] * 6, pa.string(), pa.string()]
    return arrow_sized(stream, size=ROW_BATCH_BYTES).mapInArrow(
        lambda b: _hashes(b, [*names, "repaired_sha256"], kinds), f"conv_id {kind.simpleString()}, {REPORT}, repaired_sha256 string")


def op11(spark, sf_dir):
    from kinrank.llm.common import table

    return repair_conversations(damage(table(spark, sf_dir, "conversations")))
