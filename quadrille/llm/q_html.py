"""Query of HTML extraction."""

from .common import table
from .html_text import main_texts
from .register import query


@query("op9_html_extraction")
def op9_html_extraction(spark, folder):
    """The main text of every page."""
    return main_texts(table(spark, folder, "pages"))
