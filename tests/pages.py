"""Small page frames for fixture tests."""

from pagesift.functions import text as tx
from pagesift.operators import profile
from pagesift.plans.render import SITE
from pagesift.sources.html_nodes import with_nodes


def parsed(spark, *pages):
    rows = [(n, html) for n, html in enumerate(pages)]
    return with_nodes(spark.createDataFrame(rows, "page_num INT, html STRING").coalesce(1))


def evaluate(spark, html, expression):
    return parsed(spark, html).selectExpr(f"{expression} AS x").first().x


def profile_of(spark, html, url="https://x/profil-sekolah/_", bounded=False, only=None):
    """Fields of a profile page; ``only`` names one field and spares planning the others."""
    pages = with_nodes(spark.createDataFrame([(url, html)], "url STRING, html STRING").coalesce(1))
    if only:
        field = profile.field_expressions(SITE, bounded)[only]
        return profile.with_blocks(pages).selectExpr(f"{field} AS {only}").first().asDict()
    return profile.profile_details(pages, SITE, bounded=bounded).first().asDict()


def literal(spark, expression, value):
    frame = spark.createDataFrame([(value,)], "v STRING").coalesce(1)
    return frame.selectExpr(f"{expression('v')} AS x").first().x


__all__ = ["tx", "parsed", "evaluate", "profile_of", "literal"]
