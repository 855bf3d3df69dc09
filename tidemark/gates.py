"""A failed data gate stops a job."""


class DataGateError(RuntimeError):
    pass
