"""Query of the quality classifier."""

from .common import table
from .quality import classify
from .register import query


@query("op7_quality_classifier")
def op7_quality_classifier(spark, folder):
    """Weak label and score of every document."""
    return classify(table(spark, folder, "documents"))
