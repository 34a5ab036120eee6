"""Read-only SQL entered by a user, judged by its parsed plan."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.sinks.pinned import pin

# What a query may be made of. Commands, scripts run on executors, writes and what later versions add are none of these.
PLANS = frozenset(
    """
    Aggregate Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset
    OneRowRelation OneRowRelation$ Pivot Project Range ResolvedInlineTable Sample Sort SubqueryAlias Union Unpivot
    UnresolvedHaving UnresolvedHint UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases
    UnresolvedTVFAliases UnresolvedTableValuedFunction UnresolvedWith Window WithWindowDefinition
    """.split()
)
TABLE_FUNCTIONS = frozenset(
    "range explode explode_outer posexplode posexplode_outer inline inline_outer json_tuple stack "
    "variant_explode variant_explode_outer".split()
)
# Built-in functions that call Java methods by name.
REFUSED_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})
# Expressions the parser leaves open, but for functions; names that are only made up later are none of them.
OPEN_EXPRESSIONS = frozenset(
    """
    MultiAlias NamedParameter PosParameter ResolvedStar UnresolvedAlias UnresolvedAttribute UnresolvedExtractValue
    UnresolvedOrdinal UnresolvedRegex UnresolvedStar UnresolvedStarExceptOrReplace UnresolvedStarWithColumns
    UnresolvedStarWithColumnsRenames UnresolvedWithinGroup
    """.split()
)
_PLAN = "org.apache.spark.sql.catalyst.plans.logical."
_UNRESOLVED = "org.apache.spark.sql.catalyst.analysis."
_EXPRESSION = "org.apache.spark.sql.catalyst.expressions."
# Expressions that call code by name or that a user registered; built-in functions are still unresolved here.
_REFUSED_EXPRESSIONS = frozenset({"CallMethodViaReflection", "TryReflect", "ScalaUDF", "PythonUDF", "objects"})


class RejectedQuery(ValueError):
    """The text is not a read-only query."""


class UnparsedQuery(RejectedQuery):
    """The text is no single statement of the language."""


@dataclass(frozen=True)
class QueryResult:
    success: bool
    data: DataFrame | None
    row_count: int
    execution_time_ms: float
    error: str | None = None


class _Walk:
    """Goes through all nodes of a parsed plan, those in fields and subqueries included."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        load = self.jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass
        self.iterable, self.product = load("scala.collection.Iterable"), load("scala.Product")
        self.node, self.expression = load("org.apache.spark.sql.catalyst.trees.TreeNode"), load(_EXPRESSION + "Expression")

    def nodes(self, value: Any) -> Iterator[Any]:
        """Every tree node in a value: itself, and what its fields, lists, options and tuples hold."""
        waiting = [value]
        while waiting:
            value = waiting.pop()
            if not hasattr(value, "getClass"):
                continue
            if self.node.isInstance(value):
                yield value
            if self.product.isInstance(value):
                parts = value.productIterator()
            elif self.iterable.isInstance(value):
                parts = value.iterator()
            else:
                continue
            while parts.hasNext():
                waiting.append(parts.next())


def check_read_only(spark: SparkSession, text: str) -> None:
    """Refuses what is no query: commands, scripts, functions that run code, files named as tables.

    Words don't matter, only what the parser makes of them, so literals, names and
    comments may hold anything. A table of several name parts has to be in the catalog,
    as ``format.`path``` would read files past it; functions are the built-in ones.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as error:
        raise UnparsedQuery(str(error)) from None
    walk = _Walk(spark)
    builtin = walk.jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    identifier = walk.jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
    for node in walk.nodes(plan):
        name = node.getClass().getName()
        kind = name.rsplit(".", 1)[1]
        if kind == "UnresolvedFunction":
            function = _parts(node.nameParts())
            if len(function) > 1 or function[0].lower() in REFUSED_FUNCTIONS or not builtin.functionExists(identifier(function[0].lower())):
                raise RejectedQuery(f"function not allowed: {'.'.join(function)}")
        elif kind in ("UnresolvedTableValuedFunction", "UnresolvedGenerator"):
            function = _parts(node.name()) if kind != "UnresolvedGenerator" else node.name().unquotedString().split(".")
            if len(function) > 1 or function[0].lower() not in TABLE_FUNCTIONS:
                raise RejectedQuery(f"function not allowed: {'.'.join(function)}")
        elif kind == "UnresolvedRelation":
            table = _parts(node.multipartIdentifier())
            if len(table) > 1 and not spark.catalog.tableExists(".".join(f"`{p.replace('`', '``')}`" for p in table)):
                raise RejectedQuery(f"no table of the catalog: {'.'.join(table)}")
        elif walk.expression.isInstance(node):
            allowed = kind in OPEN_EXPRESSIONS if name.startswith(_UNRESOLVED) else name.startswith((_EXPRESSION, _PLAN))
            if not allowed or _REFUSED_EXPRESSIONS & set(name.split(".")):
                raise RejectedQuery(f"expression not allowed: {kind}")
        elif kind not in PLANS or not name.startswith((_PLAN, _UNRESOLVED)):
            raise RejectedQuery(f"operation not allowed: {kind}")


def _parts(names: Any) -> list[str]:
    return [names.apply(i) for i in range(names.length())]


def read_only_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """The query's result, lazily; values are bound by name, never spliced into the text."""
    check_read_only(spark, text)
    return spark.sql(text, args=dict(args or {}))


def execute(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> QueryResult:
    """Runs the query once, into the shared folder; rows and their number are read from there.

    Failures, of the parser too, come back as a result; refusals are raised. Types that a
    file can't hold come back as text.
    """
    start = time.monotonic()
    try:
        data = _stored(read_only_sql(spark, text, args))
        rows, error = data.count(), None
    except UnparsedQuery as failure:
        data, rows, error = None, 0, str(failure)
    except RejectedQuery:
        raise
    except Exception as failure:
        data, rows, error = None, 0, str(failure)
    return QueryResult(error is None, data, rows, (time.monotonic() - start) * 1000, error)


def _stored(df: DataFrame) -> DataFrame:
    """The rows written once, whatever the names of the columns and however often they repeat."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    unwritable = (T.NullType, T.CalendarIntervalType)
    plain = plain.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, unwritable) else F.col(f.name) for f in plain.schema
    ])
    return pin(plain, "query").toDF(*df.columns)


def preview(df: DataFrame, rows: int = 15) -> DataFrame:
    """The first rows of an ordered result."""
    return df.limit(rows)
