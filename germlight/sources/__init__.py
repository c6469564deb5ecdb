"""Sources. register(spark) makes the formats `bam`, `bam_places`, `bam_parts` and `fastq` known to a session."""


def register(spark) -> None:
    from germlight.sources.bam import BamParts, BamPlaces, BamSource
    from germlight.sources.fastq import FastqSource

    for source in (BamSource, BamPlaces, BamParts, FastqSource):
        spark.dataSource.register(source)
