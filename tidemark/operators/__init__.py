"""DataFrame -> DataFrame operators. None of them triggers a job by itself
unless its name says so (``check_*``)."""
