"""One exception per failure mode, so callers never parse message text."""


class TabproofError(Exception):
    """Base class of every error this package raises."""


class SourceError(TabproofError):
    """A source location cannot be used."""

    def __init__(self, path, reason):
        self.path = path
        self.reason = reason
        super().__init__(f"{path}: {reason}")


class SourceNotFoundError(SourceError):
    """Nothing exists at the location."""


class SourceFormatError(SourceError):
    """The location does not name a CSV file."""


class SourceReadError(SourceError):
    """The file exists but is not a well-formed table."""


class InvalidTableError(TabproofError):
    """A table breaks its contract; ``report`` holds every finding."""

    def __init__(self, report, findings):
        self.report = report
        self.findings = findings
        listed = "; ".join(f"{row['code']}: {row['message']}" for row in findings)
        super().__init__(f"{len(findings)} contract violation(s): {listed}")


class PreparationError(TabproofError):
    """Feature preparation cannot be carried out."""


class FeatureInputError(PreparationError):
    """The frame does not carry the features the contract asks for."""


class SplitError(PreparationError):
    """The table cannot be divided into train and test as requested."""


class EvaluationError(TabproofError):
    """Labels, scores or metric requests do not make sense."""


class UnknownModelError(TabproofError):
    """No baseline of that name is registered."""


class ArtifactError(TabproofError):
    """A saved model or its metadata cannot be written or read."""
