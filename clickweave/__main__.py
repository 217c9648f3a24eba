"""Run the ingest query on the topic: `spark-submit --packages <kafka> ... -m clickweave`."""

from clickweave.config import Settings
from clickweave.session import create_session
from clickweave.sinks.lake import Lake
from clickweave.sources.messages import topic_stream
from clickweave.streaming.ingest import start_ingest


def main() -> None:
    settings = Settings.from_env()
    spark = create_session()
    start_ingest(
        topic_stream(spark, settings),
        Lake(settings.lake_root),
        f"{settings.checkpoint_root}/ingest",
        settings,
        as_of=None,
    ).awaitTermination()


if __name__ == "__main__":
    main()
