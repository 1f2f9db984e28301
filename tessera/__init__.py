"""tessera: Spark-native curation, validation and scoring of text-to-query corpora.

Every public function is either ``Column -> Column`` (package ``functions``) or
``DataFrame -> DataFrame`` (package ``operators``). Nothing is collected to the driver.
"""

__version__ = "0.1.0"
