"""Ad-hoc queries that can only read: every node and function of the plan must be on a list.

The text is parsed by Spark without being run. The parsed plan, with its subqueries and
named subqueries, must consist of nodes that read (``NODES``); every relation in it must be
a named subquery, a view or a table of the catalog, or one of ``tables`` if that is given;
every function must be a built-in one that reaches nothing outside the query. Commands,
writes, script transforms, scripts, dynamic statements and relations named by a path are
no such nodes or relations, so they are refused however they are spelled.

The analysed plan is looked at again, for what a name turned out to be: reflection, user
functions and file relations outside a view. The bodies of views are their owners' affair
and are not entered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# nodes of a parsed query that read, combine or cut rows
NODES = frozenset("""
Aggregate CTERelationDef CTERelationRef Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit
LocalRelation Offset OneRowRelation Pivot Project Range RepartitionByExpression ResolvedInlineTable Sample Sort SubqueryAlias
Union UnresolvedHaving UnresolvedHint UnresolvedInlineTable UnresolvedOrdinal UnresolvedRelation
UnresolvedSubqueryColumnAliases UnresolvedTVFAliases UnresolvedTableValuedFunction UnresolvedWith Unpivot Window
WithCTE WithWindowDefinition
""".split())
# functions that return rows from their arguments alone
TABLE_FUNCTIONS = frozenset("explode explode_outer inline inline_outer json_tuple posexplode posexplode_outer range stack".split())
# built-in functions that call other code or look outside the query
REFUSED_FUNCTIONS = frozenset("""
current_catalog current_database current_schema current_user input_file_block_length input_file_block_start input_file_name
java_method reflect session_user try_reflect user version
""".split())
# what a resolved expression or node must not be, by class name
REFUSED_CLASSES = frozenset("""
ApplyFunctionExpression CallMethodViaReflection HiveGenericUDF HiveGenericUDTF HiveSimpleUDF HiveUDAFFunction PythonUDAF
PythonUDF PythonUDTF ScalaAggregator ScalaUDAF ScalaUDF ScriptInputOutputSchema ScriptTransformation SQLFunctionExpression
""".split())
# names that stand for something else only when the plan is analysed
REFUSED_UNRESOLVED = frozenset("ExpressionWithUnresolvedIdentifier PlanWithUnresolvedIdentifier NamedParameter PosParameter".split())

ONE_QUERY = re.compile(r"\s*((?:select|with)\b[^;]*);*\s*", re.IGNORECASE)


class Refused(ValueError):
    """The text is no query that may run; the message says why."""


def _each(sequence) -> list:
    return [sequence.apply(k) for k in range(sequence.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _inside(expression) -> Iterator:
    """An expression with everything below it, the plans of subqueries as nodes."""
    waiting = [expression]
    while waiting:
        one = waiting.pop()
        yield one
        waiting.extend(_each(one.children()))


def _is_subquery(expression) -> bool:
    jvm_class = expression.getClass()
    while jvm_class is not None:
        if jvm_class.getSimpleName() in ("PlanExpression", "SubqueryExpression", "FunctionTableSubqueryArgumentExpression"):
            return True
        jvm_class = jvm_class.getSuperclass()
    return False


def walk(plan, enter_views: bool = True) -> Iterator[tuple[str, object]]:
    """("node" or "expression", object) for a JVM plan, its subqueries and named subqueries."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield "node", node
        if not enter_views and _kind(node) == "View":
            continue
        for expression in _each(node.expressions()):
            for one in _inside(expression):
                yield "expression", one
                if _is_subquery(one):
                    waiting.append(one.plan())
        waiting.extend(_each(node.children()))
        # named subqueries are inner children of the node that declares them
        waiting.extend(inner for inner in _each(node.innerChildren()) if hasattr(inner, "innerChildren"))


def _names(node) -> list[str]:
    return [str(part) for part in _each(node.multipartIdentifier())]


def _declared(plan) -> set[str]:
    """Names of the subqueries that WITH declares, at any depth."""
    found = set()
    for what, node in walk(plan):
        if what == "node" and _kind(node) == "UnresolvedWith":
            found |= {str(pair._1()).lower() for pair in _each(node.cteRelations())}
    return found


def built_in_functions(spark: SparkSession) -> set[str]:
    return {row[0].lower() for row in spark.sql("SHOW SYSTEM FUNCTIONS").collect()}


def _function_name(parts: list[str], built_in: set[str]) -> str:
    """The built-in function that a name can only mean, or an error."""
    name = parts[-1].lower()
    if len(parts) > 1 or name not in built_in or name in REFUSED_FUNCTIONS:
        raise Refused(f"function {'.'.join(parts)} is not allowed")
    return name


def _check_parsed(spark: SparkSession, plan, tables: set[str] | None) -> None:
    built_in, declared = built_in_functions(spark), _declared(plan)
    temporary = {row[0].lower() for row in spark.sql("SHOW USER FUNCTIONS").collect()}
    for what, node in walk(plan):
        kind = _kind(node)
        if kind in REFUSED_UNRESOLVED or kind in REFUSED_CLASSES:
            raise Refused(f"{kind} is not allowed")
        if what == "node" and kind not in NODES:
            raise Refused(f"{kind} is not allowed in a query that reads")
        if kind == "UnresolvedRelation":
            parts = _names(node)
            if len(parts) == 1 and parts[0].lower() in declared:
                continue
            shown = ".".join(f"`{part.replace('`', '``')}`" for part in parts)
            if tables is not None and ".".join(parts).lower() not in tables:
                raise Refused(f"relation {shown} is not among the tables given")
            if len(parts) > 3 or not spark.catalog.tableExists(shown):
                raise Refused(f"relation {shown} is no view and no table of the catalog")
        elif kind in ("UnresolvedFunction", "UnresolvedGenerator", "UnresolvedTableValuedFunction"):
            parts = ([str(part) for part in _each(node.nameParts())] if kind == "UnresolvedFunction" else
                     [str(part) for part in _each(node.name())] if kind == "UnresolvedTableValuedFunction" else
                     [str(node.name().funcName())])
            name = _function_name(parts, built_in)
            if name in temporary:
                raise Refused(f"function {name} hides a built-in one")
            if kind == "UnresolvedTableValuedFunction" and name not in TABLE_FUNCTIONS:
                raise Refused(f"table function {name} is not allowed")


def _check_analysed(plan) -> None:
    for what, node in walk(plan, enter_views=False):
        kind = _kind(node)
        if kind in REFUSED_CLASSES:
            raise Refused(f"{kind} is not allowed")
        if what == "node" and kind == "LogicalRelation" and node.catalogTable().isEmpty():
            raise Refused("a relation named by a path is not allowed")
        if what == "node" and kind.endswith("Command"):
            raise Refused(f"{kind} is not allowed")


def read_only_query(spark: SparkSession, sql: str, limit: int = 200, tables: list[str] | None = None) -> DataFrame:
    """One SELECT or WITH statement that only reads, capped at ``limit`` rows; ``Refused`` otherwise.

    Any semicolon inside the text is refused, also in a literal. ``tables`` limits the
    relations to these names. The cap is an operator over the query's own plan, so an ORDER
    BY in it decides which rows are seen.
    """
    accepted = ONE_QUERY.fullmatch(sql)
    if accepted is None:
        raise Refused("only one SELECT or WITH statement is allowed")
    if limit < 0:
        raise Refused("the number of rows cannot be negative")
    parser = spark._jsparkSession.sessionState().sqlParser()
    _check_parsed(spark, parser.parsePlan(accepted.group(1)), None if tables is None else {name.lower() for name in tables})
    found = spark.sql(accepted.group(1))
    _check_analysed(found._jdf.queryExecution().analyzed())
    return found.limit(limit)
