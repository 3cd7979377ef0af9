"""Token files of all documents, read back."""

from loomframe.llm.common import shared_folder
from loomframe.llm.registry import query, table
from loomframe.llm.token_files import default_tokenizer, read_documents, write_token_files


@query("op10_token_files")
def op10(spark, sf):
    folder = shared_folder(spark)
    write_token_files(table(spark, sf, "documents"), folder, default_tokenizer())
    return read_documents(spark, folder)
