"""Physical plan nodes of a DataFrame, for tests of plan shapes."""


def exchanges(df):
    """(partitioning, output columns) of every shuffle of the initial plan, equal ones (which Spark reuses) once."""
    out = {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            node = node.initialPlan()
            name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            columns = [node.output().apply(i).name() for i in range(node.output().size())]
            out.setdefault(node.semanticHash(), (node.outputPartitioning().toString(), tuple(columns)))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return list(out.values())
