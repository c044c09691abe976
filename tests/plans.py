"""Look into executed plans."""


def nodes(df):
    """Every physical operator of a frame that has run, stages of adaptive execution included."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
            return
        yield plan
        if name.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        children = plan.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    yield from walk(df._jdf.queryExecution().executedPlan())


def output_rows(df):
    """(operator, rows it put out) of a frame that has run, where counted."""
    out = []
    for plan in nodes(df):
        found = plan.metrics().get("numOutputRows")
        if found.isDefined():
            out.append((plan.nodeName(), found.get().value()))
    return out
