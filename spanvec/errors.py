"""One small exception tree for caller mistakes that can be seen up front."""


class CollectionError(Exception):
    """Base of every error raised by this package."""


class SourceError(CollectionError):
    """A source cannot be read as asked."""


class SchemaError(CollectionError):
    """Columns or types do not fit the declared collection."""


class SearchError(CollectionError):
    """A search was asked for with unusable parameters."""
