"""Small hand-made citation files."""

HEADER = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE PubmedArticleSet>\n'

FULL = """<PubmedArticle>
  <MedlineCitation Status="MEDLINE">
    <PMID Version="1">101</PMID>
    <Article PubModel="Print">
      <Journal><JournalIssue CitedMedium="Print"><Volume>012</Volume><Issue>3</Issue>
        <PubDate><Year>2015</Year><Month>Jul</Month><Day>07</Day></PubDate></JournalIssue>
        <Title>Journal of Tests</Title><ISOAbbreviation>J Tests</ISOAbbreviation></Journal>
      <ArticleTitle>A <i>b</i> c &lt; d<!-- note --> <![CDATA[& e]]></ArticleTitle>
      <AuthorList CompleteYN="Y">
        <Author ValidYN="Y"><LastName>Kim</LastName><ForeName>Ana</ForeName><Initials>A</Initials>
          <Suffix>Jr</Suffix><Identifier Source="ORCID">0000-1</Identifier>
          <AffiliationInfo><Affiliation>Univ X Hospital, Norland</Affiliation></AffiliationInfo>
          <AffiliationInfo><Affiliation>Univ X, H<sub>2</sub>O Dept, Sudland</Affiliation></AffiliationInfo>
        </Author>
        <Author ValidYN="N"><LastName>Lee</LastName></Author>
      </AuthorList>
      <DataBankList CompleteYN="Y">
        <DataBank><DataBankName>GENBANK</DataBankName><AccessionNumberList>
          <AccessionNumber>AF1</AccessionNumber><AccessionNumber>AF2</AccessionNumber>
        </AccessionNumberList></DataBank>
        <DataBank><DataBankName>EMPTY</DataBankName></DataBank>
      </DataBankList>
    </Article>
    <MeshHeadingList>
      <MeshHeading><DescriptorName UI="D1" MajorTopicYN="N">Heart</DescriptorName>
        <QualifierName UI="Q1" MajorTopicYN="Y">surgery</QualifierName>
        <QualifierName UI="Q2" MajorTopicYN="N">anatomy</QualifierName></MeshHeading>
      <MeshHeading><DescriptorName UI="D2" MajorTopicYN="Y">Lung</DescriptorName></MeshHeading>
    </MeshHeadingList>
    <KeywordList Owner="NOTNLM"><Keyword MajorTopicYN="N">alpha</Keyword>
      <Keyword MajorTopicYN="Y">beta</Keyword></KeywordList>
  </MedlineCitation>
  <PubmedData>
    <History>
      <PubMedPubDate PubStatus="received"><Year>2012</Year><Month>1</Month><Day>2</Day></PubMedPubDate>
      <PubMedPubDate PubStatus="pubmed"><Year>2013</Year><Month>5</Month><Day>6</Day></PubMedPubDate>
      <PubMedPubDate PubStatus="pubmed"><Year>2014</Year><Month>Jul</Month><Day>8</Day></PubMedPubDate>
    </History>
    <ReferenceList>
      <Reference><Citation>First ref</Citation><ArticleIdList>
        <ArticleId IdType="DOI">10.1/a</ArticleId><ArticleId IdType="doi">10.1/b</ArticleId>
        <ArticleId IdType="unknown">zz</ArticleId><ArticleId IdType="pubmed">55</ArticleId>
      </ArticleIdList></Reference>
      <Reference><Citation>Second ref</Citation></Reference>
    </ReferenceList>
  </PubmedData>
</PubmedArticle>"""

SINGLE = """<PubmedArticle><MedlineCitation><PMID>102</PMID><Article>
<ArticleTitle>One of each</ArticleTitle>
<AuthorList><Author ValidYN="Y"><LastName>Solo</LastName>
<AffiliationInfo><Affiliation>Univ X, Norland</Affiliation></AffiliationInfo></Author></AuthorList>
<DataBankList CompleteYN="N"><DataBank><DataBankName>PDB</DataBankName><AccessionNumberList>
<AccessionNumber>1ABC</AccessionNumber></AccessionNumberList></DataBank></DataBankList></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D3" MajorTopicYN="N">Eye</DescriptorName>
<QualifierName UI="Q3" MajorTopicYN="N">injuries</QualifierName></MeshHeading></MeshHeadingList>
<KeywordList><Keyword MajorTopicYN="N">gamma</Keyword></KeywordList></MedlineCitation>
<PubmedData><History><PubMedPubDate PubStatus="pubmed"><Year>2016</Year><Month>2</Month><Day>3</Day>
</PubMedPubDate></History><ReferenceList><Reference><Citation>Only ref</Citation><ArticleIdList>
<ArticleId IdType="pii">S1</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData>
</PubmedArticle>"""

BARE = "<PubmedArticle><MedlineCitation><PMID>103</PMID></MedlineCitation></PubmedArticle>"
BROKEN = "<PubmedArticle><MedlineCitation><PMID>104</PMI></MedlineCitation></PubmedArticle>"


def article_set(*articles: str) -> str:
    """A file around the articles, with elements that are not articles."""
    return (
        HEADER
        + "<PubmedArticleSet>"
        + "<PubmedBookArticle><BookDocument><PMID>9</PMID></BookDocument></PubmedBookArticle>\n"
        + "\n".join(articles)
        + "\n<DeleteCitation><PMID Version=\"1\">8</PMID></DeleteCitation></PubmedArticleSet>\n"
    )


MESH = HEADER + """<DescriptorRecordSet LanguageCode="eng">
<DescriptorRecord DescriptorClass="1"><DescriptorUI>D000001</DescriptorUI>
<DescriptorName><String>Calcimycin</String></DescriptorName>
<PharmacologicalActionList><PharmacologicalAction><DescriptorReferredTo>
<DescriptorUI>D000900</DescriptorUI><DescriptorName><String>Other</String></DescriptorName>
</DescriptorReferredTo></PharmacologicalAction></PharmacologicalActionList>
<TreeNumberList><TreeNumber>D03.633</TreeNumber><TreeNumber>C01.2</TreeNumber>
<TreeNumber>D04</TreeNumber></TreeNumberList></DescriptorRecord>
<DescriptorRecord DescriptorClass="1"><DescriptorUI>D000002</DescriptorUI>
<DescriptorName><String>Treeless</String></DescriptorName></DescriptorRecord>
</DescriptorRecordSet>"""

REGISTRY = """[
 {"id": "r1", "name": "Univ X", "country": {"country_code": "NO", "country_name": "Norland"}},
 {"id": "r2", "name": "Univ X Hospital", "country": {"country_code": "SU", "country_name": "Sudland"}},
 {"id": "r3", "name": "Dup", "country": {"country_code": "NO", "country_name": "Norland"}},
 {"id": "r4", "name": "Dup", "country": {"country_code": "XX", "country_name": "Sudland"}},
 {"id": "r5", "country": {"country_code": "QQ", "country_name": "Nameless"}},
 {"id": "r6", "name": "Stateless Lab"}
]"""
