"""Running a user's SQL over their secured views only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, TimestampNTZType, TimestampType

from silverbrook.plans.secured import secured_views
from silverbrook.session import configure

# What a user's SQL may consist of. Spark's own expressions are
# taken if they are deterministic; what has no input of its own, where things
# from outside would come in, must be named here. Then expressions that hold a
# plan, and relations without stored rows.
_BUILT_IN = "org.apache.spark.sql.catalyst.expressions."
_USER_DEFINED = _BUILT_IN + "UserDefinedExpression"
_LEAVES = (
    "AttributeReference", "OuterReference", "Literal", "NamedLambdaVariable", "CommonExpressionRef",
    "CurrentDate", "CurrentTimestamp", "CurrentTime", "LocalTimestamp", "Now",
    "CurrentRow", "UnboundedPreceding", "UnboundedFollowing",
    "RowNumber", "Rank", "DenseRank", "PercentRank", "CumeDist",
    "Pi", "EulerNumber",
    "CreateArray", "CreateMap", "CreateNamedStruct", "Concat",
)
_SUBQUERIES = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
_HARMLESS = ("OneRowRelation", "LocalRelation", "CTERelationRef")


class RefusedQuery(ValueError):
    """A user's SQL reaches for something other than their views."""


Marts = dict[str, DataFrame]


def check_user_id(raw: object) -> int:
    """The id as a positive integer, or ``ValueError``."""
    try:
        user_id = int(raw)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        user_id = 0
    if user_id <= 0:
        raise ValueError("'user_id' must be a positive integer")
    return user_id


def _plain(name: str, data_type: DataType) -> Column:
    """Decimals as doubles, dates and times as ISO text, the rest unchanged."""
    column = F.col(f"`{name}`")
    if isinstance(data_type, DecimalType):
        column = column.cast("double")
    elif isinstance(data_type, DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(data_type, (TimestampType, TimestampNTZType)):
        seconds = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(column, "SSSSSS")
        fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
        offset = F.date_format(column, "xxx") if isinstance(data_type, TimestampType) else F.lit("")
        column = F.concat(seconds, fraction, offset)
    return column.alias(name)


def _items(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _refuse_in_expression(spark: SparkSession, expression) -> None:
    """Only Spark's own expressions over the views' columns, literals and the current time."""
    children = _items(expression.children())
    allowed = (
        expression.getClass().getName().startswith(_BUILT_IN)
        and expression.deterministic()
        and not is_instance_of(spark.sparkContext._gateway, expression, _USER_DEFINED)
        and (bool(children) or _kind(expression) in (*_LEAVES, *_SUBQUERIES))
    )
    if not allowed:
        raise RefusedQuery(f"{expression.toString()[:80]} is not allowed")
    for child in children:
        _refuse_in_expression(spark, child)


def _reads_a_view(plan) -> bool:
    return _kind(plan) == "View" or any(map(_reads_a_view, _items(plan.children())))


def _refuse_in_plan(spark: SparkSession, plan, views: set[str]) -> None:
    """Walk an analysed plan; inside a view of the user's nothing is looked at."""
    kind = _kind(plan)
    if kind == "View":
        name = plan.desc().identifier().table()
        if name not in views or not plan.isTempView():
            raise RefusedQuery(f"{name} is not one of the user's views")
        return
    children = _items(plan.children())
    if not children and kind not in _HARMLESS:
        raise RefusedQuery(f"only the user's views can be read, not {kind}")
    if kind == "Generate" and not _reads_a_view(plan):
        raise RefusedQuery("a table function needs rows of a view")
    for child in children:
        _refuse_in_plan(spark, child, views)
    for expression in _items(plan.expressions()):
        _refuse_in_expression(spark, expression)
        for nested in _subqueries(expression):
            _refuse_in_plan(spark, nested, views)


def _subqueries(expression) -> list:
    own = [expression.plan()] if _kind(expression) in _SUBQUERIES else []
    return own + [p for child in _items(expression.children()) for p in _subqueries(child)]


def query_as_user(
    spark: SparkSession,
    sql: str,
    user_id: object,
    load: Callable[[SparkSession], tuple[Marts, DataFrame]],
    max_rows: int | None = None,
) -> DataFrame:
    """Run one query as a user, in a session that holds nothing but their views.

    All rows are returned, unless ``max_rows`` is given: then at most that many,
    and ``answer_as_user`` tells whether rows were cut.

    ``load`` builds the marts and the entitlements in the session it is given.
    The SQL stands in a subquery, so commands are refused, it cannot name
    files, and ``${...}`` in it stands for itself and not for a setting or the
    environment. It may use Spark's own deterministic expressions over its
    views and nothing that tells of the host; the marts themselves must not be
    in a catalog the session shares with others. Results hold only permitted rows; as in any engine without an
    optimisation barrier, a predicate of the user's own may be evaluated
    before the row filter.
    """
    return answer_as_user(spark, sql, user_id, load, max_rows).rows


@dataclass(frozen=True)
class Answer:
    rows: DataFrame
    #: Whether rows beyond ``max_rows`` were cut.
    cut: bool


def answer_as_user(
    spark: SparkSession,
    sql: str,
    user_id: object,
    load: Callable[[SparkSession], tuple[Marts, DataFrame]],
    max_rows: int | None = None,
) -> Answer:
    """As ``query_as_user``, with word of rows that were cut."""
    user = check_user_id(user_id)
    session = configure(spark.newSession())
    marts, entitlements = load(session)
    views = secured_views(marts, entitlements, user)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    session.conf.set("spark.sql.variable.substitute", "false")
    result = session.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")
    _refuse_in_plan(session, result._jdf.queryExecution().analyzed(), set(views))
    cut = False
    if max_rows is not None:
        cut = not result.offset(max_rows).isEmpty()
        result = result.limit(max_rows)
    return Answer(result.select(*[_plain(f.name, f.dataType) for f in result.schema.fields]), cut)
