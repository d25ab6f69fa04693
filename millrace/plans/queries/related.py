"""Relationship queries, role policies and entity fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import access, entities, relations
from millrace.operators.relations import Relation
from millrace.plans.queries.registry import iso_second, registered, table


@registered(
    "nested_orders",
    """
    SELECT c.c_custkey, row_number() OVER (PARTITION BY c.c_custkey ORDER BY o.o_orderdate DESC,
           o.o_orderkey) AS place, o.o_orderkey, o.o_totalprice
    FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
    UNION ALL
    SELECT c_custkey, NULL, NULL, NULL FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    """,
)
def nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their orders, newest first; flattened again to be compared."""
    nested = relations.nest_children(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "orders"),
        "c_custkey",
        "o_custkey",
        "orders",
        order_by=[F.desc("o_orderdate"), F.col("o_orderkey")],
        columns=["o_orderkey", "o_totalprice"],
    )
    return nested.select("c_custkey", F.posexplode_outer("orders").alias("p", "o")).select(
        "c_custkey",
        (F.col("p") + 1).cast("long").alias("place"),
        F.col("o.o_orderkey").alias("o_orderkey"),
        F.col("o.o_totalprice").alias("o_totalprice"),
    )


@registered(
    "nested_latest_order",
    """
    SELECT c_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at
    FROM customer LEFT JOIN (
        SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
    ) ON o_custkey = c_custkey
    """,
)
def nested_latest_order(spark: SparkSession, sf: str) -> DataFrame:
    nested = relations.nest_children(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "orders"),
        "c_custkey",
        "o_custkey",
        "orders",
        order_by=[F.desc("o_orderdate"), F.asc("o_orderkey")],
        columns=["o_orderkey", "o_orderdate"],
        limit=1,
    )
    latest = F.get("orders", 0)
    return nested.select(
        "c_custkey",
        latest["o_orderkey"].alias("o_orderkey"),
        iso_second(latest["o_orderdate"]).alias("ordered_at"),
    )


@registered(
    "embedded_parent",
    """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def embedded_parent(spark: SparkSession, sf: str) -> DataFrame:
    embedded = relations.embed_parent(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "o_custkey",
        "c_custkey",
        "customer",
    )
    return embedded.select("o_orderkey", "customer.c_name", "customer.c_mktsegment")


@registered(
    "where_tree",
    """
    SELECT event_id, event_type, user_id FROM events
    WHERE event_type IN ('click', 'error') AND (value > 20 OR value < 1)
    """,
)
def where_tree(spark: SparkSession, sf: str) -> DataFrame:
    tree = {
        "_and": [
            {"event_type": {"_in": ["click", "error"]}},
            {"_or": [{"value": {"_gt": 20}}, {"value": {"_lt": 1}}]},
        ]
    }
    return relations.where(table(spark, sf, "events"), tree).select(
        "event_id", "event_type", "user_id"
    )


@registered(
    "where_count",
    """
    SELECT count(*) AS count FROM events WHERE event_type = 'purchase' AND value >= 10
    """,
)
def where_count(spark: SparkSession, sf: str) -> DataFrame:
    tree = {"event_type": {"_eq": "purchase"}, "value": {"_gte": 10}}
    return relations.count_where(table(spark, sf, "events"), tree)


def _customer_orders(spark: SparkSession, sf: str) -> dict[str, Relation]:
    graph = relations.relationship_graph(
        {n: table(spark, sf, n) for n in ("nation", "customer", "orders")},
        [
            relations.ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
            relations.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ],
    )
    return graph["customer"]


@registered(
    "where_relation",
    """
    SELECT c_custkey, c_name FROM customer c
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
      AND (NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
           OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                      AND o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 300000))
    """,
)
def where_relation(spark: SparkSession, sf: str) -> DataFrame:
    tree = {
        "nation": {"n_regionkey": {"_eq": 1}},
        "_or": [
            {"orders_aggregate": {"count": {"predicate": {"_eq": 0}}}},
            {"orders": {"o_orderpriority": {"_eq": "1-URGENT"}, "o_totalprice": {"_gt": 300000}}},
        ],
    }
    customers = table(spark, sf, "customer")
    return relations.where(customers, tree, _customer_orders(spark, sf)).select(
        "c_custkey", "c_name"
    )


@registered(
    "part_list_per_order",
    """
    SELECT l_orderkey, 0 AS part,
           string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts
    FROM lineitem GROUP BY l_orderkey
    """,
)
def part_list_per_order(spark: SparkSession, sf: str) -> DataFrame:
    return relations.joined_text(
        table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_partkey"), ",", "parts"
    )


POLICY = {
    "Admin": {
        "select": {"columns": "*", "filter": {}, "allow_aggregations": True},
        "insert": {"columns": "*", "check": {}},
        "update": {"columns": "*", "filter": {}},
        "delete": {"filter": {}},
    },
    "Clerk": {
        "select": {
            "columns": ["o_orderkey", "o_custkey", "o_totalprice"],
            "filter": {"o_orderpriority": {"_eq": "X-Priority"}},
            "allow_aggregations": True,
        },
        "insert": {
            "columns": "*",
            "check": {"o_orderpriority": {"_eq": "X-Priority"}, "o_totalprice": {"_lt": 250000}},
        },
        "update": {
            "columns": ["o_totalprice"],
            "filter": {"o_orderstatus": {"_eq": "O"}},
            "check": {"o_totalprice": {"_lt": 400000}},
        },
        "delete": {"filter": {"o_orderstatus": {"_in": ["F", "P"]}}},
    },
    "Viewer": {
        "select": {"columns": ["o_orderkey", "o_orderstatus"], "filter": {}, "limit": 25},
    },
}
SESSION = {"x-priority": "1-URGENT"}


@registered(
    "secure_view_user",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def secure_view_user(spark: SparkSession, sf: str) -> DataFrame:
    return access.secure_view(table(spark, sf, "orders"), POLICY, "Clerk", SESSION)


@registered(
    "secure_view_capped",
    """
    SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
    """,
)
def secure_view_capped(spark: SparkSession, sf: str) -> DataFrame:
    return access.secure_view(
        table(spark, sf, "orders"), POLICY, "Viewer", SESSION,
        order_by=[F.desc("o_totalprice"), F.asc("o_orderkey")],
    )


@registered(
    "secure_aggregate",
    """
    SELECT count(*) AS n_orders, max(o_totalprice) AS largest FROM orders
    WHERE o_orderpriority = '1-URGENT'
    """,
)
def secure_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return access.secure_aggregate(
        table(spark, sf, "orders"), POLICY, "Clerk", SESSION,
        F.count("*").alias("n_orders"), F.max("o_totalprice").alias("largest"),
    )


@registered(
    "write_check_split",
    """
    SELECT o_orderkey, o_orderpriority = '1-URGENT' AND o_totalprice < 250000 AS accepted
    FROM orders
    """,
)
def write_check_split(spark: SparkSession, sf: str) -> DataFrame:
    checked = access.check_insert(table(spark, sf, "orders"), POLICY, "Clerk", SESSION)
    yes = access.permitted(checked).select("o_orderkey", F.lit(True).alias("accepted"))
    no = access.refused(checked).select("o_orderkey", F.lit(False).alias("accepted"))
    return yes.unionByName(no)


@registered(
    "update_check",
    """
    SELECT o_orderkey, o_totalprice + 50000 AS o_totalprice,
           o_orderstatus = 'O' AND o_totalprice + 50000 < 400000 AS permitted
    FROM orders WHERE o_orderpriority = '5-LOW'
    """,
)
def update_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    changes = orders.where("o_orderpriority = '5-LOW'").select(
        "o_orderkey", (F.col("o_totalprice") + 50000).alias("o_totalprice")
    )
    checked = access.check_update(orders, changes, ["o_orderkey"], POLICY, "Clerk", SESSION)
    return checked.select("o_orderkey", "o_totalprice", F.col("_permitted").alias("permitted"))


@registered(
    "delete_check",
    """
    SELECT o_orderkey, o_orderstatus IN ('F', 'P') AS permitted FROM orders
    """,
)
def delete_check(spark: SparkSession, sf: str) -> DataFrame:
    checked = access.check_delete(table(spark, sf, "orders"), POLICY, "Clerk", SESSION)
    return checked.select("o_orderkey", F.col("_permitted").alias("permitted"))


def change_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as build records: the type is the organization, users are pipelines."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        F.lit("forge").alias("data_artifact_source"),
        kind.alias("data_artifact_organization"),
        F.concat(F.lit("repo"), k).alias("data_artifact_repository"),
        F.col("event_id").cast("string").alias("data_artifact_id"),
        F.lit("runner").alias("data_run_source"),
        kind.alias("data_run_organization"),
        F.concat(F.lit("pipe"), user).alias("data_run_pipeline"),
        F.when(F.col("value") >= 5, F.col("event_id").cast("string")).alias("data_run_id"),
        F.struct(kind.alias("category"), user.alias("detail")).alias("run_status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_start_time"),
        F.lit("feed").alias("data_origin"),
        F.lit("git").alias("data_commit_source"),
        kind.alias("data_commit_organization"),
        F.concat(F.lit("repo"), k).alias("data_commit_repository"),
        F.md5(F.col("event_id").cast("string")).alias("data_commit_sha"),
        F.when(F.col("value") >= 8, F.lit("fleet")).alias("data_deploy_source"),
        F.concat(F.lit("d"), user).alias("data_deploy_id"),
        F.concat(F.lit("app"), k).alias("uid"),
        F.concat(F.lit("App "), k).alias("name"),
        F.lit("web").alias("platform"),
    )


@registered(
    "entity_fanout",
    """
    SELECT 'artifact' AS entity,
           'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id AS id,
           'forge|' || event_type || '|repo' || (props ->> '$.k') AS parent,
           CASE WHEN value >= 5 THEN 'runner|' || event_type || '|pipe' || user_id || '|' || event_id END
               AS detail
    FROM events
    UNION ALL
    SELECT 'build', 'runner|' || event_type || '|pipe' || user_id || '|' || event_id,
           'runner|' || event_type || '|pipe' || user_id,
           event_type || ' ' || user_id || ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S')
    FROM events WHERE value >= 5
    UNION ALL
    SELECT DISTINCT 'repository', 'forge|' || event_type || '|repo' || (props ->> '$.k'),
           'forge|' || event_type, 'repo' || (props ->> '$.k')
    FROM events
    UNION ALL
    SELECT DISTINCT 'pipeline', 'runner|' || event_type || '|pipe' || user_id,
           'runner|' || event_type, 'pipe' || user_id
    FROM events
    UNION ALL
    SELECT DISTINCT 'organization', s || '|' || event_type, s, event_type
    FROM events, (VALUES ('forge'), ('runner')) AS sides(s)
    UNION ALL
    SELECT 'artifact_commit_association',
           'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id
               || '|git|' || event_type || '|repo' || (props ->> '$.k') || '|' || md5(event_id::VARCHAR),
           'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id,
           'git|' || event_type || '|repo' || (props ->> '$.k') || '|' || md5(event_id::VARCHAR)
    FROM events
    UNION ALL
    SELECT 'artifact_deployment',
           'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id || '|fleet|d' || user_id,
           'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id, 'fleet|d' || user_id
    FROM events WHERE value >= 8
    UNION ALL
    SELECT DISTINCT 'deployment', 'fleet|d' || user_id, 'fleet', 'd' || user_id FROM events WHERE value >= 8
    UNION ALL
    SELECT DISTINCT 'application', 'app' || (props ->> '$.k'), 'web', 'App ' || (props ->> '$.k') FROM events
    """,
)
def entity_fanout(spark: SparkSession, sf: str) -> DataFrame:
    found = entities.fan_out(change_records(spark, sf))

    def shown(name: str, parent: str, detail) -> DataFrame:
        return found[name].select(
            F.lit(name).alias("entity"), "id", F.col(parent).alias("parent"), detail.alias("detail")
        )

    built = F.concat_ws(" ", "statusCategory", "statusDetail", iso_second("startedAt"))
    return (
        shown("artifact", "repository", F.col("build"))
        .unionByName(shown("build", "pipeline", built))
        .unionByName(shown("repository", "organization", F.col("uid")))
        .unionByName(shown("pipeline", "organization", F.col("uid")))
        .unionByName(shown("organization", "source", F.col("uid")))
        .unionByName(shown("artifact_commit_association", "artifact", F.col("commit")))
        .unionByName(shown("artifact_deployment", "artifact", F.col("deployment")))
        .unionByName(shown("deployment", "source", F.col("uid")))
        .unionByName(shown("application", "platform", F.col("name")))
    )
