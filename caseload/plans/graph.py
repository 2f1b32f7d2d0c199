"""A graph of models: what each reads, the order to build them in, and what lies below a change."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from ..sources.sinks import Outcome

#: Models built at the same time; Spark shares its executors among their jobs.
AT_ONCE = 6


@dataclass(frozen=True)
class Model:
    """A model by name: `build` makes it from the frames of the names that it `reads`, in order."""

    name: str
    build: Callable[..., DataFrame]
    reads: tuple[str, ...]
    is_view: bool = False


class ModelGraph:
    """Models over named sources. Unknown and repeated names and cycles are errors."""

    def __init__(self, models: Iterable[Model], sources: Collection[str]):
        self.models: dict[str, Model] = {}
        self.sources = frozenset(sources)
        for model in models:
            if model.name in self.models or model.name in self.sources:
                raise ValueError(f"two models or sources are named {model.name}")
            self.models[model.name] = model
        for model in self.models.values():
            unknown = [n for n in model.reads if n not in self.models and n not in self.sources]
            if unknown:
                raise ValueError(f"{model.name} reads unknown names: {', '.join(unknown)}")
        try:
            self.order = [n for n in self._sorter(self.models).static_order()]
        except CycleError as error:
            raise ValueError(f"models read each other: {' <- '.join(error.args[1])}") from None

    def _sorter(self, names: Collection[str]) -> TopologicalSorter:
        return TopologicalSorter({n: [r for r in self.models[n].reads if r in names] for n in names})

    def below(self, changed: Iterable[str]) -> set[str]:
        """The models that read one of these names, or a model that does; changed models are among them."""
        reached = set(changed)
        if unknown := reached - self.models.keys() - self.sources:
            raise ValueError(f"unknown names: {', '.join(sorted(unknown))}")
        for name in self.order:
            if not reached.isdisjoint(self.models[name].reads):
                reached.add(name)
        return reached & self.models.keys()

    def above(self, wanted: Iterable[str]) -> set[str]:
        """These models, and all models that they read."""
        reached = set(wanted)
        if unknown := reached - self.models.keys():
            raise ValueError(f"unknown models: {', '.join(sorted(unknown))}")
        for name in reversed(self.order):
            if name in reached:
                reached.update(r for r in self.models[name].reads if r in self.models)
        return reached

    def build(
        self,
        read: Callable[[str], DataFrame],
        publish: Callable[[Model, DataFrame], Outcome],
        names: Collection[str] | None = None,
        at_once: int = AT_ONCE,
    ) -> list[Outcome]:
        """Build the models `names` (default: all), each once all that it reads among them are built.

        `read` gives the frame of a name, `publish` stores a model. Models that do not wait for each
        other are built at the same time. Below a model that fails, models are skipped; all outcomes
        are returned, in the order of the graph.
        """
        chosen = set(self.models if names is None else names)
        sorter, outcomes = self._sorter(chosen), {}

        def run(model: Model) -> Outcome:
            try:
                return publish(model, model.build(*map(read, model.reads)))
            except Exception as error:
                return Outcome(model.name, "failed", message=str(error).split("\n")[0])

        sorter.prepare()
        with ThreadPoolExecutor(at_once) as threads:
            running = {}
            while sorter.is_active():
                for name in sorter.get_ready():
                    lost = [r for r in self.models[name].reads if r in outcomes and outcomes[r].status != "loaded"]
                    if lost:
                        outcomes[name] = Outcome(name, "skipped", message=f"not built: {', '.join(lost)}")
                        sorter.done(name)
                    else:
                        running[threads.submit(run, self.models[name])] = name
                for done in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                    name = running.pop(done)
                    outcomes[name] = done.result()
                    sorter.done(name)
        return [outcomes[name] for name in self.order if name in outcomes]


def together(jobs: Mapping[str, Callable[[], Outcome]], at_once: int = AT_ONCE) -> dict[str, Outcome]:
    """Run independent jobs at the same time."""
    with ThreadPoolExecutor(at_once) as threads:
        running = {name: threads.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}
