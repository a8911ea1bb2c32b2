"""The registered queries and, where SQL can say it, their SQL equivalents."""

from workload.views import portable, with_views

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None, views: tuple = ()):
    """Register a function (spark, sf_dir) -> DataFrame under a name."""
    def register(build):
        QUERIES[name] = lambda spark, sf: portable(build(spark, sf))
        if sql is not None:
            ORACLE[name] = with_views(sql, *views) if views else sql.strip()
        return build
    return register
