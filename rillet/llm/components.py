"""Connected components of a graph given by its edges."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import group_totals, salts, written

#: Steps of the scrambling of node numbers, and the pointers followed in one round.
TURNS, POINTERS = 3, 3


def _scrambled(node: Column, turns) -> Column:
    """A one-to-one scrambling of 64-bit numbers: a Feistel network over their halves."""
    for turn in turns:
        low = node.bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(node, 32)
        hashed = F.hash(low, F.lit(turn)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        node = F.shiftleft(low, 32).bitwiseOR(high.bitwiseXOR(hashed))
    return node


def _halves_swapped(node: Column) -> Column:
    return F.shiftleft(node, 32).bitwiseOR(F.shiftrightunsigned(node, 32))


def scrambled(node: Column) -> Column:
    """The number that stands for a node during the search."""
    return _scrambled(node, range(TURNS))


def unscrambled(node: Column) -> Column:
    """The node that a number stands for: the same steps backwards on swapped halves."""
    return _halves_swapped(_scrambled(_halves_swapped(node), reversed(range(TURNS))))


def contracted(edges: DataFrame) -> list[DataFrame]:
    """No table if there are no edges, else one: (node, parent) takes each node to its component.

    ``edges`` has the long columns ``a`` and ``b``.  The component is named by its smallest node; nodes
    without edges are not in the table.

    Each round points every node to its smallest neighbour, follows a few pointers and replaces the ends
    of all edges; what is left are edges between least nodes of their neighbourhoods.  Nodes are compared
    by scrambled numbers, so neighbours are in random order whatever the ids are: at most half of the
    nodes of a path stay, about a third as a rule, and a star takes two rounds.  The number of rounds
    grows with the logarithm of the longest path.  Each round is written and read back, so that its plan
    is short and a lost executor recomputes one round only.  The pointers of all rounds become one
    table from the last round backwards: the tables shrink as the graph does.  Only whether edges
    are left reaches the driver.
    """
    rounds: list[DataFrame] = []
    edges = written(_proper(edges.select(scrambled(F.col("a")).alias("a"), scrambled(F.col("b")).alias("b"))))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        pointers = least.select("node", F.least("node", "least").alias("parent"))
        rounds.append(written(replaced(pointers, "parent", [pointers] * POINTERS)))
        edges = written(_proper(replaced(replaced(edges, "a", rounds[-1:]), "b", rounds[-1:])))
    if not rounds:
        return []
    whole = rounds.pop()
    while rounds:
        whole = written(replaced(rounds.pop(), "parent", [whole]))
    nodes = whole.select(unscrambled(F.col("node")).alias("node"), F.col("parent").alias("root"))
    nodes = nodes.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts(edges.sparkSession))).cast("int"))
    smallest = group_totals(nodes, "root", "salt", {"parent": ("min", "node")})
    return [written(nodes.join(smallest, ["root", "salt"]).select("node", "parent"))]


def _proper(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def replaced(rows: DataFrame, column: str, tables: list[DataFrame]) -> DataFrame:
    """``rows`` with the nodes in ``column`` taken through the tables."""
    for table in tables:
        step = table.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
        rows = (
            rows.join(step, F.col(column) == F.col("_node"), "left")
            .withColumn(column, F.coalesce("_parent", column))
            .drop("_node", "_parent")
        )
    return rows
