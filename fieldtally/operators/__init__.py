"""DataFrame in, DataFrame out; none of these starts a job, except ``find_source``."""
