"""Spreading an input that would leave most of the cluster idle."""


def spread(df):
    """``df`` over more partitions when it has fewer than the cluster has cores.

    Worth it before costly work per row on files with few row groups or topics with few partitions.
    An input large enough to fill the cluster comes back as it is, without a shuffle. The adaptive
    planner merges the new partitions again where they would be tiny.
    """
    if df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism:
        return df.hint("repartition")
    return df


TASKS_A_CORE = 4


def deal(df):
    """``df`` over four tasks a core of as many rows each, when it has fewer but keeps all cores busy.

    For work so costly per row that the time is that of the busiest core. A file's row groups cannot
    be divided, so a large input often comes as little more tasks than there are cores, or as tasks
    of which many are empty: a second wave of one task then takes as long as the first. An input of
    fewer tasks than cores is only spread, so that small ones stay in few tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores <= df.rdd.getNumPartitions() < TASKS_A_CORE * cores:
        return df.repartition(TASKS_A_CORE * cores)
    return spread(df)
